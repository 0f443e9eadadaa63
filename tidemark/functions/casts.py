"""Casts from untrusted text: a bad value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the long text form of a start or end time, e.g. "Feb 3, 2023, 7:15 AM".
LONG_TIME_FORMAT = "MMM d, yyyy, h:mm a"


def text_to_decimal(text: Column, precision: int, scale: int) -> Column:
    """Excess digits round half up; a value too large for the type is NULL."""
    return text.try_cast(f"decimal({precision},{scale})")


def text_to_whole(text: Column) -> Column:
    """Whole number from text, rounding ``'8.5'`` to 9 (a direct int cast gives NULL)."""
    return text.try_cast("decimal(38,0)").try_cast("int")


def text_to_date(text: Column) -> Column:
    return text.try_cast("date")


def text_to_wall_clock(text: Column) -> Column:
    """Timestamp from either text form; an offset is dropped, the wall clock kept.

    Only the long form starts with a letter. Each text is parsed in one way, as a
    failed parse costs far more than a good one.
    """
    long_form = F.try_to_timestamp(text, F.lit(LONG_TIME_FORMAT)).cast("timestamp_ntz")
    return F.when(text.rlike("^\\s*[A-Za-z]"), long_form).otherwise(text.try_cast("timestamp_ntz"))


def monday_of(day: Column) -> Column:
    return F.trunc(day, "WEEK").cast("date")


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two times, so 00:00:59 to 00:01:01 counts 1."""
    floor = [F.date_trunc("minute", c).cast("timestamp") for c in (start, end)]
    return F.timestamp_diff("MINUTE", floor[0], floor[1])


def weeks_between(earlier: Column, later: Column) -> Column:
    """Whole weeks between two Mondays."""
    return (F.datediff(later, earlier) / F.lit(7)).cast("int")


def metres_to_km(metres: Column) -> Column:
    """Kilometres with 4 digits; 0 and NULL both mean "not recorded"."""
    return F.round(F.nullif(metres, F.lit(0)) / F.lit(1000), 4)
