"""Exact ratios and rounding.

Reports compare ratios with fixed thresholds, so a last-bit error flips a label.
All ratios are one single decimal division of exact operands; rounding is half
away from zero, as a warehouse rounds its decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# decimal(20,4) / decimal(20,4) yields decimal(38,18): 16 integer digits in, 18 fraction digits out.
OPERAND = "decimal(20,4)"


def exact(value: Column) -> Column:
    return value.cast(OPERAND)


def ratio(num: Column, den: Column) -> Column:
    """``num / den``; NULL when the denominator is 0 or NULL."""
    return exact(num) / F.nullif(exact(den), F.lit(0).cast(OPERAND))


def rounded(value: Column, digits: int) -> Column:
    return F.round(value, digits).cast(f"decimal(24,{digits})")


def rounded_ratio(num: Column, den: Column, digits: int) -> Column:
    return rounded(ratio(num, den), digits)


def percent_change(now: Column, before: Column, digits: int = 1) -> Column:
    """Change from ``before`` to ``now`` in percent; NULL when there is no base."""
    return rounded_ratio((exact(now) - exact(before)) * F.lit(100), before, digits)
