"""Weekly volume per category against thresholds, and the weekly balance on top."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.arith import percent_change, rounded, rounded_ratio
from tidemark.functions.casts import weeks_between
from tidemark.functions.labels import push_pull_status, quad_ham_status, volume_status
from tidemark.operators.calendar import calendar_frame, latest_hit, previous_period, series_window
from tidemark.operators.grid import complete_grid
from tidemark.operators.rollup import Total, counted, counted_if, from_parts, largest, part, parts, summed
from tidemark.session import scratch_path
from tidemark.sources.files import stage

MEASURES = [
    "direct_sets", "indirect_sets", "total_reps", "total_tonnage", "unique_exercises",
    "training_days", "failure_sets", "unloaded_sets",
]
LIST = "secondary_muscle_groups"
# A week's days are the bits of a number; a date outside its week is kept as it is.
ODD_DAY = "_odd_day"
DISTINCT = {"unique_exercises": "exercise_title", "_odd_days": ODD_DAY}


def _totals() -> list[Total]:
    return [
        counted("direct_sets"),
        summed("reps", "total_reps"),
        summed("tonnage", "total_tonnage", "decimal(20,2)"),
        summed("weight_kg", "_weight", "decimal(20,2)"),
        largest("weight_kg", "max_weight_kg"),
        counted_if("is_failure_set", "failure_sets"),
        counted_if("is_unloaded_set", "unloaded_sets"),
        Total("_days", F.bit_or("_day_bit"), F.bit_or),
    ]


def week_parts(sets: DataFrame, entity: Sequence[str]) -> DataFrame:
    """The one aggregate that weeks, direct and indirect work come from, written once to the shared folder.

    A row per entity, week, muscle, exercise and list of further muscles: the days of a week fall together.
    """
    named = sets.filter(F.col("workout_date").isNotNull()).withColumnRenamed("primary_muscle", "muscle")
    offset = F.datediff("workout_date", "week_start")
    in_week = F.coalesce(offset.between(0, 6), F.lit(False))
    named = named.withColumns(
        {
            "_day_bit": F.when(in_week, F.call_function("shiftleft", F.lit(1), offset)),
            ODD_DAY: F.when(~in_week, F.col("workout_date")),
        }
    )
    reduced = parts(named, [*entity, "week_start", "muscle", LIST], _totals(), list(DISTINCT.values()))
    return stage(reduced, scratch_path(sets.sparkSession, "week_parts"))


def direct_work(reduced: DataFrame, entity: Sequence[str]) -> DataFrame:
    work = from_parts(reduced, [*entity, "week_start", "muscle"], _totals(), DISTINCT)
    days = F.coalesce(F.bit_count("_days"), F.lit(0)) + F.col("_odd_days")
    return work.withColumn("training_days", days).drop("_days", "_odd_days")


def indirect_work(reduced: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Sets credited to each member of the JSON list; unreadable lists credit nobody.

    Sets are counted per list first, so each distinct list is parsed once per week.
    """
    per_list = (
        reduced.filter(F.col(LIST).isNotNull())
        .groupBy(*entity, "week_start", LIST)
        .agg(F.sum(part("direct_sets")).alias("n"))
    )
    members = F.explode(F.from_json(LIST, "array<string>"))
    return (
        per_list.select(*entity, "week_start", "n", members.alias("muscle"))
        .groupBy(*entity, "week_start", "muscle")
        .agg(F.sum("n").alias("indirect_sets"))
    )


def category_week(
    sets: DataFrame, landmarks: DataFrame, entity: Sequence[str] = (), calendar_weeks: bool = False
) -> DataFrame:
    """One row per entity, week and listed category, also where nothing was done.

    Weeks are those with any set; ``calendar_weeks`` adds wholly idle weeks in
    between. Categories missing from ``landmarks`` are left out.
    """
    entity = list(entity)
    reduced = week_parts(sets, entity)
    weeks = reduced.select(*entity, "week_start").distinct()
    if calendar_weeks:
        span = weeks.groupBy(*entity).agg(F.min("week_start").alias("a"), F.max("week_start").alias("b"))
        weeks = span.select(*entity, F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("week_start"))
    grid = complete_grid(weeks, landmarks, ["muscle"])
    on = [*entity, "week_start", "muscle"]
    combined = grid.join(direct_work(reduced, entity), on, "left").join(indirect_work(reduced, entity), on, "left")
    combined = combined.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(combined.schema[c].dataType)) for c in MEASURES})
    combined = combined.withColumn("_week", F.unix_date("week_start"))

    series = [*entity, "muscle"]
    w = series_window(series, F.col("_week"))
    month = calendar_frame(series, "week_start", -27, 0)
    trained = latest_hit(F.col("direct_sets") > 0, F.col("week_start"), w)
    before = previous_period(
        {"direct_sets": "prev_week_sets", "total_tonnage": "prev_week_tonnage"}, series, "week_start", 7
    )
    full = combined.withColumns(
        {
            "weeks_since_trained": weeks_between(trained, F.col("week_start")),
            "_sum4": F.sum("direct_sets").over(month),
            "_n4": F.count(F.lit(1)).over(month),
            **before,
        }
    )
    return full.select(
        *entity,
        "week_start",
        F.year("week_start").alias("year"),
        "muscle",
        "movement_group",
        "direct_sets",
        "indirect_sets",
        rounded(F.col("direct_sets") + F.col("indirect_sets") * F.lit("0.5").cast("decimal(2,1)"), 1).alias("effective_sets"),
        "total_reps",
        "total_tonnage",
        rounded_ratio(F.col("_weight"), F.col("direct_sets"), 2).alias("avg_weight_kg"),
        "max_weight_kg",
        "unique_exercises",
        "training_days",
        "failure_sets",
        "unloaded_sets",
        "mev_sets",
        "mav_sets",
        "mrv_sets",
        "weeks_since_trained",
        rounded_ratio(F.col("_sum4"), F.col("_n4"), 1).alias("sets_4wk_avg"),
        "prev_week_sets",
        "prev_week_tonnage",
        percent_change(F.col("total_tonnage"), F.col("prev_week_tonnage")).alias("tonnage_pct_change"),
        volume_status(F.col("direct_sets"), F.col("mev_sets"), F.col("mav_sets"), F.col("mrv_sets")).alias("volume_status"),
    )


# The two categories whose ratio is reported on its own.
QUAD, HAM = "quadriceps", "hamstrings"


def week_balance(category_weeks: DataFrame, entity: Sequence[str] = (), distinct_days: DataFrame | None = None) -> DataFrame:
    """One row per entity and week with group totals, ratios and their bands.

    ``training_days`` is the largest count over the categories. Pass the sets as
    ``distinct_days`` to also get ``distinct_training_days`` over all of them.
    """
    entity = list(entity)
    sets_where = lambda cond: F.sum(F.when(cond, F.col("direct_sets")).otherwise(0))
    of_group = lambda g: sets_where(F.col("movement_group") == g)
    weeks = category_weeks.groupBy(*entity, "week_start", "year").agg(
        F.max("training_days").alias("training_days"),
        F.sum("direct_sets").alias("total_sets"),
        F.sum("total_reps").alias("total_reps"),
        F.sum("total_tonnage").cast("decimal(20,2)").alias("total_tonnage"),
        of_group("push").alias("push_sets"),
        of_group("pull").alias("pull_sets"),
        of_group("legs").alias("leg_sets"),
        of_group("core").alias("core_sets"),
        sets_where(F.col("muscle") == QUAD).alias("quad_sets"),
        sets_where(F.col("muscle") == HAM).alias("hamstring_sets"),
        *[
            F.count_if(F.col("volume_status") == status).alias(f"muscles_{status}")
            for status in ("below_mev", "not_trained", "above_mrv")
        ],
    )
    full = weeks.withColumns(
        {
            "push_pull_ratio": rounded_ratio(F.col("push_sets"), F.col("pull_sets"), 2),
            "quad_ham_ratio": rounded_ratio(F.col("quad_sets"), F.col("hamstring_sets"), 2),
            **previous_period({"total_tonnage": "prev_week_tonnage"}, entity, "week_start", 7),
        }
    )
    out = full.select(
        "*",
        percent_change(F.col("total_tonnage"), F.col("prev_week_tonnage")).alias("tonnage_pct_change"),
        push_pull_status(F.col("pull_sets"), F.col("push_pull_ratio")).alias("push_pull_status"),
        quad_ham_status(F.col("hamstring_sets"), F.col("quad_ham_ratio")).alias("quad_ham_status"),
    )
    if distinct_days is not None:
        days = distinct_days.groupBy(*entity, "week_start").agg(
            F.count_distinct("workout_date").alias("distinct_training_days")
        )
        out = out.join(days, [*entity, "week_start"], "left")
    return out
