"""Gap-free daily series per entity and windows in calendar time.

Groups here hold one row per entity and calendar day (or week), so the span of
the calendar bounds each window however many source rows an entity has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series_window(entity: Sequence[str], order: Column | str):
    return Window.partitionBy(*entity).orderBy(order)


def calendar_spine(df: DataFrame, entity: Sequence[str], day: str) -> DataFrame:
    """Every day from an entity's first to its last, with no upper limit on the count."""
    bounds = day_bounds(df, entity, day)
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return bounds.select(*entity, F.explode(days).alias(day))


def day_bounds(df: DataFrame, entity: Sequence[str], day: str) -> DataFrame:
    """First and last day of each entity."""
    return df.filter(F.col(day).isNotNull()).groupBy(*entity).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


def fill_days(daily: DataFrame, entity: Sequence[str], day: str, own: str, zero: Sequence[str]) -> DataFrame:
    """Add the missing days between an entity's rows.

    Expects one row per (entity, day). Each row is stretched up to the next one,
    which needs no separate spine and no join. On added days the ``zero``
    columns are 0, all others NULL; ``own`` tells the two kinds apart.
    """
    following = F.lead(day).over(series_window(entity, day))
    until = F.coalesce(F.date_sub(following, 1), F.col(day))
    stretched = daily.withColumn("_until", until).withColumn(
        "_day", F.explode(F.sequence(F.col(day), F.col("_until"), F.expr("interval 1 day")))
    )
    is_own = F.col("_day") == F.col(day)
    columns = []
    for c in daily.columns:
        if c in entity:
            columns.append(F.col(c))
        elif c == day:
            columns.append(F.col("_day").alias(day))
        elif c in zero:
            kind = daily.schema[c].dataType
            columns.append(F.when(is_own, F.col(c)).otherwise(F.lit(0).cast(kind)).alias(c))
        else:
            columns.append(F.when(is_own, F.col(c)).alias(c))
    return stretched.select(*columns, is_own.alias(own))


def trailing_sum(running: Column, entity: Sequence[str], day: str, rows: int) -> Column:
    """Sum of the last ``rows`` rows, from a running total on a gap-free series.

    A difference of running totals costs the same for 7 and for 28 days, where a
    sliding frame re-adds every row of the frame. Exact on decimals and integers.
    """
    old = F.lag(running, rows).over(series_window(entity, day))
    return running - F.coalesce(old, F.lit(0))


def running_total(value: Column, entity: Sequence[str], day: str) -> Column:
    w = series_window(entity, day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(value).over(w)


def latest_hit(condition: Column, value: Column, window) -> Column:
    """Most recent ``value`` for which ``condition`` held, up to the current row."""
    w = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.max(F.when(condition, value)).over(w)


def calendar_frame(entity: Sequence[str], day: str, first: int, last: int):
    """Window over the rows dated ``first`` to ``last`` days from the current one."""
    return Window.partitionBy(*entity).orderBy(F.unix_date(F.col(day))).rangeBetween(first, last)


def previous_period(columns: dict[str, str], entity: Sequence[str], period: str, days: int) -> dict[str, Column]:
    """Values of the period exactly ``days`` earlier; NULL across a gap. Maps column to output name.

    Same result as a self-join on the shifted date where (entity, period) is
    unique, without the second shuffle.
    """
    w = series_window(entity, F.unix_date(F.col(period)))
    adjacent = F.lag(period).over(w) == F.date_sub(F.col(period), days)
    return {out: F.when(adjacent, F.lag(src).over(w)) for src, out in columns.items()}
