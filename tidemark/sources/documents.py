"""Nested workout documents to one row per set, and the small dimension feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import metres_to_km


def _text(value: Column) -> Column:
    return value.cast("string")


def _unless_zero(value: Column) -> Column:
    """0 stands for "not recorded" in these fields."""
    return _text(F.nullif(value, F.lit(0)))


def flatten_workouts(workouts: DataFrame, keep: tuple[str, ...] = (), drop_first_superset: bool = False) -> DataFrame:
    """workout > exercises > sets, parent attributes repeated; empty arrays give no rows.

    A recorded 0 of distance, duration or effort means absent, while 0 load and
    0 repetitions are values. Superset number 0 is kept; ``drop_first_superset``
    gives the older behaviour that lost it.
    """
    per_exercise = workouts.select(
        *keep, "id", "title", "start_time", "end_time", "description", F.explode("exercises").alias("ex")
    )
    per_set = per_exercise.select("*", F.explode("ex.sets").alias("s"))
    superset = F.col("ex.superset_id")
    if drop_first_superset:
        superset = F.nullif(superset, F.lit("0"))
    return per_set.select(
        *keep,
        F.col("id").alias("workout_id"),
        "title",
        "start_time",
        "end_time",
        "description",
        F.col("ex.title").alias("exercise_title"),
        superset.alias("superset_id"),
        F.col("ex.notes").alias("exercise_notes"),
        F.coalesce("s.index", F.lit(0)).alias("set_index"),
        F.coalesce("s.type", F.lit("normal")).alias("set_type"),
        _text(F.col("s.weight_kg")).alias("weight_kg"),
        _text(F.col("s.reps")).alias("reps"),
        _text(metres_to_km(F.col("s.distance_meters"))).alias("distance_km"),
        _unless_zero(F.col("s.duration_seconds")).alias("duration_seconds"),
        _unless_zero(F.col("s.rpe")).alias("rpe"),
        F.lit("api").alias("_source"),
    )


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(changed workouts, one row with the counts of kept and skipped events).

    Only ``updated`` events with a payload are applied; deletions are counted.
    """
    applies = (F.col("type") == "updated") & F.col("workout").isNotNull()
    changed = events.filter(applies).select("workout.*")
    counts = events.agg(
        F.count_if(applies).alias("applied"), F.count_if(~F.coalesce(applies, F.lit(False))).alias("skipped")
    )
    return changed, counts


def template_rows(docs: DataFrame) -> DataFrame:
    """Exercise templates under their table names; the secondary list as JSON text."""
    return docs.select(
        F.col("id").alias("exercise_template_id"),
        "title",
        F.col("equipment").alias("equipment_category"),
        "primary_muscle_group",
        F.to_json(F.coalesce("secondary_muscle_groups", F.array().cast("array<string>"))).alias(
            "secondary_muscle_groups"
        ),
        F.coalesce("is_custom", F.lit(False)).alias("is_custom"),
    )


def measurement_rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("date").alias("measurement_date"),
        _text(F.col("weight_kg")).alias("weight_kg"),
        _text(F.col("body_fat_percentage")).alias("body_fat_pct"),
    )
