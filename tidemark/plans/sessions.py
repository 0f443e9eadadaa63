"""One row per training session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.arith import rounded_ratio
from tidemark.operators.ordering import matching
from tidemark.operators.rollup import counted, counted_if, largest, smallest, summed, totals_and_distinct
from tidemark.sources.tables import replace_groups, since_loaded


def session_summary(sets: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Totals, distinct counts and work rate per session.

    Title and venue are constant within a session; the maximum picks one.
    """
    keys = [*entity, "workout_id"]
    rolled = totals_and_distinct(
        sets.filter(F.col("workout_date").isNotNull()),
        keys,
        [
            largest("workout_title"),
            smallest("workout_date"),
            smallest("week_start"),
            largest("year"),
            largest("month"),
            smallest("start_time"),
            largest("end_time"),
            largest("session_duration_min"),
            counted("total_sets"),
            summed("tonnage", "total_tonnage", "decimal(20,2)"),
            summed("reps", "total_reps"),
            counted_if("is_failure_set", "failure_sets"),
            counted_if("is_dropset", "dropset_sets"),
            counted_if("is_superset", "superset_sets"),
            largest("gym"),
            largest("gym_detail"),
            largest("_loaded_at"),
        ],
        {"total_exercises": "exercise_title", "muscles_trained": "primary_muscle"},
    )
    per_minute = rounded_ratio(F.col("total_tonnage"), F.col("session_duration_min"), 1)
    return rolled.select(
        *keys,
        "workout_title",
        "workout_date",
        "week_start",
        "year",
        "month",
        "start_time",
        "end_time",
        "session_duration_min",
        "total_sets",
        "total_exercises",
        "muscles_trained",
        "total_tonnage",
        "total_reps",
        "failure_sets",
        "dropset_sets",
        "superset_sets",
        per_minute.alias("tonnage_per_min"),
        "gym",
        "gym_detail",
        "_loaded_at",
    )


def refresh_sessions(target: DataFrame, sets: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Re-aggregate every session with newly loaded sets over all of its sets."""
    keys = [*entity, "workout_id"]
    touched = since_loaded(sets, target).select(*keys).distinct()
    rebuilt = session_summary(matching(sets, touched, keys, "left_semi"), entity)
    return replace_groups(target, rebuilt, touched, keys)
