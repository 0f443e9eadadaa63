"""Acute to chronic load per calendar day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.arith import rounded_ratio
from tidemark.functions.labels import load_status
from tidemark.operators.calendar import (
    fill_days,
    latest_hit,
    running_total,
    series_window,
    trailing_sum,
)
from tidemark.operators.lookup import day_lookup
from tidemark.operators.rollup import counted, counted_if, largest, summed, totals_and_distinct

# The two windows, in days.
ACUTE_DAYS = 7
CHRONIC_DAYS = 28

COUNTS = ["daily_sets", "daily_exercises", "muscles_trained", "sessions", "failure_sets", "gyms_trained"]


def daily_rollup(sets: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """One row per entity and training day.

    ``gym`` and ``gym_detail`` are those of the largest single set of the day
    that has a venue; equal sets resolve to the later name.
    """
    venue = lambda c: largest(F.when(F.col(c).isNotNull(), F.struct("tonnage", c)), f"_{c}")
    rolled = totals_and_distinct(
        sets.filter(F.col("workout_date").isNotNull()),
        [*entity, "workout_date"],
        [
            summed("tonnage", "daily_tonnage", "decimal(20,2)"),
            counted("daily_sets"),
            counted_if("is_failure_set", "failure_sets"),
            largest("session_duration_min"),
            venue("gym_detail"),
            venue("gym"),
        ],
        {
            "daily_exercises": "exercise_title",
            "muscles_trained": "primary_muscle",
            "sessions": "workout_id",
            "gyms_trained": "gym_detail",
        },
    )
    return rolled.withColumns({c: F.col(f"_{c}")[c] for c in ("gym_detail", "gym")}).drop("_gym_detail", "_gym")


def add_load_ratio(
    daily: DataFrame, entity: Sequence[str], day: str, load: str, sets: str, active: str
) -> DataFrame:
    """Rolling loads, ratio and status on a gap-free daily series.

    Early days divide by the days that exist. All windows share one partitioning
    and one sort order.
    """
    w = series_window(entity, day)
    base = daily.withColumns(
        {
            "_load": running_total(F.col(load), entity, day),
            "_sets": running_total(F.col(sets), entity, day),
            "days_of_history": F.row_number().over(w),
            "days_since_last_session": F.datediff(F.col(day), latest_hit(F.col(active), F.col(day), w)),
        }
    ).withColumns(
        {
            "_acute": trailing_sum(F.col("_load"), entity, day, ACUTE_DAYS),
            "_chronic": trailing_sum(F.col("_load"), entity, day, CHRONIC_DAYS),
            "sets_last_7d": trailing_sum(F.col("_sets"), entity, day, ACUTE_DAYS),
        }
    )
    n_acute = F.least(F.col("days_of_history"), F.lit(ACUTE_DAYS))
    n_chronic = F.least(F.col("days_of_history"), F.lit(CHRONIC_DAYS))
    up, down = F.col("_acute") * n_chronic, F.col("_chronic") * n_acute
    return base.withColumns(
        {
            "rolling_7d_avg": rounded_ratio(F.col("_acute"), n_acute, 2),
            "rolling_28d_avg": rounded_ratio(F.col("_chronic"), n_chronic, 2),
            "fatigue_index": F.coalesce(rounded_ratio(up, down, 2), F.lit(0)).cast("decimal(10,2)"),
            "training_status": load_status(F.col("days_of_history"), up, down),
        }
    ).drop("_load", "_sets", "_acute", "_chronic")


def daily_load_ratio(sets: DataFrame, bodyweight: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """One row per entity and calendar day, rest days included, up to the last training day.

    The first 27 days carry a ratio but no status: their chronic window is not
    full. Load counts across venues.
    """
    rolled = daily_rollup(sets, entity)
    daily = fill_days(rolled, entity, "workout_date", "is_training_day", ["daily_tonnage", *COUNTS])
    scored = add_load_ratio(daily, entity, "workout_date", "daily_tonnage", "daily_sets", "is_training_day")
    joined = day_lookup(scored, bodyweight, ["bodyweight_kg"], entity)
    return joined.select(
        *entity,
        "workout_date",
        "is_training_day",
        "gym",
        "gym_detail",
        "gyms_trained",
        "sessions",
        "daily_tonnage",
        "daily_sets",
        "daily_exercises",
        "muscles_trained",
        "failure_sets",
        "session_duration_min",
        rounded_ratio(F.col("daily_tonnage"), F.col("session_duration_min"), 1).alias("tonnage_per_min"),
        "sets_last_7d",
        "days_since_last_session",
        "days_of_history",
        "bodyweight_kg",
        F.col("rolling_7d_avg").alias("rolling_7d_avg_tonnage"),
        F.col("rolling_28d_avg").alias("rolling_28d_avg_tonnage"),
        "fatigue_index",
        "training_status",
    )


def event_load_ratio(events: DataFrame, entity: Sequence[str], day: str, load: str) -> DataFrame:
    """The same ratio for any event log: load per entity and day."""
    daily = events.groupBy(*entity, day).agg(
        F.sum(load).cast("decimal(20,2)").alias("daily_load"), F.count(F.lit(1)).alias("daily_events")
    )
    filled = fill_days(daily, entity, day, "is_active_day", ["daily_load", "daily_events"])
    scored = add_load_ratio(filled, entity, day, "daily_load", "daily_events", "is_active_day")
    return scored.withColumnsRenamed({"sets_last_7d": "events_last_7d", "days_since_last_session": "days_since_active"})
