"""Progression and personal records per exercise and venue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.arith import percent_change, rounded_ratio
from tidemark.functions.labels import first_match, one_rep_max, trend_status
from tidemark.operators.calendar import latest_hit
from tidemark.operators.lookup import day_lookup

# The rename for exercises logged as barbell work but done on a smith machine.
LOGGED_AS, DONE_ON = "(Barbell)", "(Smith Machine)"
# Equipment whose loads compare across venues.
FREE_WEIGHTS = ["barbell", "dumbbell", "kettlebell"]

# The history is taken per entity and these.
SERIES = ["exercise_title", "gym_detail"]

# Spreads loads so far apart that repetitions fit in between: 0.01 kg is worth 10^10.
_SPREAD = 10**12


def best_sets(sets: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Heaviest set per day and exercise with the most repetitions done at that load.

    Load and repetitions are packed in one number for the arg-max: a numeric buffer
    is hash-aggregated, which a struct is not. Sets are shuffled once, by their series:
    few of them share a day and exercise, and the history per series needs no second shuffle.
    """
    title, notes = F.lower("exercise_title"), F.lower("exercise_notes")
    swapped = notes.contains("smith") & title.contains("barbell")
    renamed = F.replace(F.col("exercise_title"), F.lit(LOGGED_AS), F.lit(DONE_ON))
    usable = sets.filter(
        F.col("workout_date").isNotNull() & (F.col("weight_kg") > 0) & F.col("gym_detail").isNotNull()
    ).withColumns(
        {
            "equipment_mismatch": swapped,
            "exercise_title": F.when(swapped, renamed).otherwise(F.col("exercise_title")),
        }
    )
    usable = usable.select(
        *entity, "workout_date", "week_start", "year", "exercise_title", "gym", "gym_detail", "primary_muscle",
        "equipment_category", "equipment_mismatch", "weight_kg", "reps", "tonnage",
    ).repartition(*entity, *SERIES)
    packed = F.col("weight_kg").cast("decimal(6,2)") * F.lit(_SPREAD).cast("decimal(13,0)") + F.col("reps")
    keys = [
        *entity, "workout_date", "week_start", "year", "exercise_title", "gym", "gym_detail",
        "primary_muscle", "equipment_category",
    ]
    rolled = usable.groupBy(*keys).agg(
        F.max("equipment_mismatch").alias("equipment_mismatch"),
        F.max("weight_kg").alias("top_set_weight_kg"),
        F.max(packed).alias("_packed"),
        F.count(F.lit(1)).alias("sets_n"),
        F.sum("tonnage").cast("decimal(20,2)").alias("exercise_tonnage"),
    )
    name, gear = F.lower("exercise_title"), F.lower("equipment_category")
    one_sided = (gear == "dumbbell") | name.contains("single arm") | name.contains("single leg")
    top_reps = F.col("_packed") - F.col("top_set_weight_kg") * F.lit(_SPREAD).cast("decimal(13,0)")
    return rolled.withColumns(
        {
            "top_set_reps": top_reps.cast("int"),
            "movement_type": first_match([(one_sided, "unilateral")], "bilateral"),
        }
    ).drop("_packed")


def progression(sets: DataFrame, bodyweight: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Estimated 1RM history per (entity, exercise, venue).

    Best sets above 20 repetitions carry no estimate and are left out before any
    history is taken. A first session and a tie with the best count as records.
    A series holds at most one row per day and (muscle, equipment) of its
    exercise, so calendar time bounds every window.
    """
    entity = list(entity)
    rated = best_sets(sets, entity).withColumn(
        "estimated_1rm", one_rep_max(F.col("top_set_weight_kg"), F.col("top_set_reps"))
    ).filter(F.col("estimated_1rm").isNotNull())

    series = [*entity, *SERIES]
    by_day = F.unix_date(F.col("workout_date"))
    ties = [F.col(c).asc_nulls_last() for c in ("gym", "primary_muscle", "equipment_category")]
    stepwise = Window.partitionBy(*series).orderBy(by_day, *ties)
    so_far = stepwise.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    calendar = Window.partitionBy(*series).orderBy(by_day)
    month_ago, month = calendar.rangeBetween(-35, -21), calendar.rangeBetween(-27, 0)
    e1rm = F.col("estimated_1rm")
    history = rated.withColumns(
        {
            "sessions_logged": F.count(F.lit(1)).over(Window.partitionBy(*series)),
            "best_1rm_to_date": F.max(e1rm).over(so_far),
            "_ago_sum": F.sum(e1rm).over(month_ago),
            "_ago_n": F.count(e1rm).over(month_ago),
            "_now_sum": F.sum(e1rm).over(month),
            "_now_n": F.count(e1rm).over(month),
        }
    ).withColumn("is_pr", e1rm >= F.col("best_1rm_to_date"))
    history = history.withColumns(
        {
            "days_since_pr": F.datediff(
                F.col("workout_date"), latest_hit(F.col("is_pr"), F.col("workout_date"), stepwise)
            ),
            # against the mean, with the division by its count multiplied out
            "e1rm_pct_change_4wk": percent_change(e1rm * F.col("_ago_n"), F.col("_ago_sum")),
        }
    )
    weighed = day_lookup(history, bodyweight, ["bodyweight_kg"], entity)
    return weighed.select(
        *entity,
        "workout_date",
        "week_start",
        "year",
        "exercise_title",
        "primary_muscle",
        "equipment_category",
        "movement_type",
        "gym",
        "gym_detail",
        "sets_n",
        "top_set_weight_kg",
        "top_set_reps",
        "exercise_tonnage",
        "estimated_1rm",
        "best_1rm_to_date",
        "is_pr",
        "days_since_pr",
        "sessions_logged",
        rounded_ratio(F.col("_ago_sum"), F.col("_ago_n"), 2).alias("e1rm_4wk_ago"),
        rounded_ratio(F.col("_now_sum"), F.col("_now_n"), 2).alias("e1rm_4wk_avg"),
        "e1rm_pct_change_4wk",
        "equipment_mismatch",
        "bodyweight_kg",
        rounded_ratio(e1rm, F.col("bodyweight_kg"), 2).alias("e1rm_per_kg_bodyweight"),
        F.lower("equipment_category").isin(*FREE_WEIGHTS).alias("is_cross_gym_comparable"),
        trend_status(F.col("sessions_logged"), F.col("_ago_sum"), F.col("e1rm_pct_change_4wk")).alias("progression_trend"),
    )


def all_time_bests(progress: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Best estimate, heaviest load and latest record date per exercise and venue."""
    keys = [*entity, "exercise_title", "gym_detail", "primary_muscle", "equipment_category"]
    return progress.groupBy(*keys).agg(
        F.max("best_1rm_to_date").alias("best_e1rm"),
        F.max("top_set_weight_kg").alias("heaviest_weight_kg"),
        F.max(F.when(F.col("is_pr"), F.col("workout_date"))).alias("last_pr_date"),
        F.bool_or("is_cross_gym_comparable").alias("is_cross_gym_comparable"),
        F.count(F.lit(1)).alias("sessions_logged"),
    )
