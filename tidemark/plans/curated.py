"""Date-bounded report queries over the finished tables.

``as_of`` is the reporting day; by default the newest day of each entity, so
that a report does not depend on the clock. The row limit holds for each entity
too; without entity columns the table is one log. Ties in the ordering resolve by
the rest of the columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import top_rows
from tidemark.plans.progress import all_time_bests

# Reach in days and row limit of each report.
REPORTS = {
    "fatigue": (30, 30),
    "volume": (56, 200),
    "balance": (56, 12),
    "strength": (28, 100),
    "pr": (None, 100),
    "sessions": (30, 30),
    "raw_sets": (7, 200),
}


# Ranges of days that a report's scan is bounded by at most; the nearest ones are joined beyond that.
MOST_RANGES = 16


def _recent(df: DataFrame, column: str, days: int, as_of: date | None, entity: Sequence[str]) -> DataFrame:
    """Rows of the last ``days`` days before the reporting day.

    Each entity's newest day is a small aggregate over two columns. The distinct ones (no more than there are
    days in the calendar) give ranges of days outside which no row is wanted. They are literals, so the scan skips
    what lies beyond them; inside, the join with each entity's own newest day decides.
    """
    if as_of is not None:
        return df.filter(F.col(column) >= F.lit(as_of - timedelta(days=days)))
    if not entity:
        newest = df.agg(F.max(column)).first()[0]
        return _recent(df, column, days, newest, ()) if newest is not None else df.filter(F.lit(False))
    newest_days = df.groupBy(*entity).agg(F.max(column).alias("_newest")).select("_newest").distinct()
    ranges = day_ranges([r[0] for r in newest_days.collect() if r[0] is not None], days, MOST_RANGES)
    near = df.filter(reduce(Column.__or__, [F.col(column).between(F.lit(a), F.lit(b)) for a, b in ranges], F.lit(False)))
    newest = near.groupBy(*[F.col(e).alias(f"_of_{e}") for e in entity]).agg(F.max(column).alias("_newest"))
    same = reduce(Column.__and__, [F.col(e).eqNullSafe(F.col(f"_of_{e}")) for e in entity])
    return near.join(newest, same & (F.col(column) >= F.date_sub("_newest", days))).select(*df.columns)


def day_ranges(newest: Sequence[date], days: int, most: int) -> list[tuple[date, date]]:
    """At most ``most`` ranges that hold each day and the ``days`` days before it."""
    ranges: list[tuple[date, date]] = []
    for last in sorted(newest):
        first = last - timedelta(days=days)
        if ranges and first <= ranges[-1][1] + timedelta(days=1):
            ranges[-1] = (ranges[-1][0], last)
        else:
            ranges.append((first, last))
    while len(ranges) > most:
        k = min(range(len(ranges) - 1), key=lambda n: ranges[n + 1][0] - ranges[n][1])
        ranges[k:k + 2] = [(ranges[k][0], ranges[k + 1][1])]
    return ranges


def _report(
    df: DataFrame, name: str, column: str, columns: Sequence[str], order: Sequence[str], as_of, entity: Sequence[str], limit: int | None
) -> DataFrame:
    days, usual = REPORTS[name]
    shown = _recent(df, column, days, as_of, entity).select(*entity, *columns)
    return _cut(shown, order, limit or usual, entity)


def _cut(shown: DataFrame, order: Sequence[str], limit: int, entity: Sequence[str]) -> DataFrame:
    """The first rows of each entity; Spark keeps no more of them per task before the shuffle."""
    lead = [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in order]
    named = {c.lstrip("-") for c in order}
    rest = [F.col(c).asc_nulls_last() for c in shown.columns if c not in named]
    if not entity:
        return top_rows(shown, [*lead, *rest], limit)
    place = F.row_number().over(Window.partitionBy(*entity).orderBy(*lead, *rest))
    return shown.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")


def fatigue(days: DataFrame, as_of: date | None = None, entity: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    columns = [
        "workout_date", "is_training_day", "gym_detail", "daily_tonnage", "daily_sets",
        "days_since_last_session", "rolling_7d_avg_tonnage", "rolling_28d_avg_tonnage",
        "fatigue_index", "training_status",
    ]
    return _report(days, "fatigue", "workout_date", columns, ["-workout_date"], as_of, entity, limit)


def volume(category_weeks: DataFrame, as_of: date | None = None, entity: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    columns = [
        "week_start", "muscle", "movement_group", "direct_sets", "indirect_sets", "effective_sets",
        "total_tonnage", "mev_sets", "mav_sets", "volume_status", "weeks_since_trained", "tonnage_pct_change",
    ]
    return _report(category_weeks, "volume", "week_start", columns, ["-week_start", "-direct_sets"], as_of, entity, limit)


def balance(weeks: DataFrame, as_of: date | None = None, entity: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    columns = [
        "week_start", "training_days", "total_sets", "push_sets", "pull_sets", "leg_sets", "core_sets",
        "push_pull_ratio", "push_pull_status", "quad_ham_ratio", "quad_ham_status",
        "muscles_below_mev", "muscles_not_trained",
    ]
    return _report(weeks, "balance", "week_start", columns, ["-week_start"], as_of, entity, limit)


def strength(progress: DataFrame, as_of: date | None = None, entity: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    columns = [
        "workout_date", "exercise_title", "gym_detail", "primary_muscle", "top_set_weight_kg", "top_set_reps",
        "estimated_1rm", "best_1rm_to_date", "is_pr", "days_since_pr", "e1rm_pct_change_4wk",
        "progression_trend", "e1rm_per_kg_bodyweight", "is_cross_gym_comparable",
    ]
    return _report(progress, "strength", "workout_date", columns, ["-workout_date", "-estimated_1rm"], as_of, entity, limit)


def personal_records(progress: DataFrame, entity: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    return _cut(all_time_bests(progress, entity), ["-best_e1rm"], limit or REPORTS["pr"][1], entity)


def sessions(summary: DataFrame, as_of: date | None = None, entity: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    columns = [
        "workout_date", "workout_title", "gym_detail", "total_sets", "total_exercises", "muscles_trained",
        "total_tonnage", "session_duration_min", "tonnage_per_min",
    ]
    return _report(summary, "sessions", "workout_date", columns, ["-workout_date"], as_of, entity, limit)


def raw_sets(sets: DataFrame, as_of: date | None = None, entity: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    columns = [
        "workout_date", "workout_title", "gym_detail", "exercise_title", "primary_muscle", "set_index",
        "set_type", "weight_kg", "reps", "tonnage",
    ]
    order = ["-workout_date", "exercise_title", "set_index"]
    return _report(sets, "raw_sets", "workout_date", columns, order, as_of, entity, limit)
