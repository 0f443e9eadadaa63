"""Group totals together with several distinct counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import matching, oversized_groups

# A group up to this many rows has its distinct values gathered by one task.
ONE_GROUP_ROWS = 1_000_000


def part(name: str) -> str:
    """The column of ``parts`` that holds a total, which may be named like a counted column."""
    return f"_part_{name}"


@dataclass(frozen=True)
class Total:
    """An aggregate that can be taken in two steps: over rows, then over the results of parts of them."""

    name: str
    over_rows: Column
    over_parts: Callable[[str], Column]
    kind: str | None = None

    def first(self) -> Column:
        return self.over_rows.alias(part(self.name))

    def last(self) -> Column:
        return self._typed(self.over_parts(part(self.name)))

    def whole(self) -> Column:
        return self._typed(self.over_rows)

    def _typed(self, value: Column) -> Column:
        return (value.cast(self.kind) if self.kind else value).alias(self.name)


def summed(column: str, name: str | None = None, kind: str | None = None) -> Total:
    return Total(name or column, F.sum(column), F.sum, kind)


def counted(name: str) -> Total:
    return Total(name, F.count(F.lit(1)), F.sum)


def counted_if(flag: str | Column, name: str) -> Total:
    return Total(name, F.count_if(flag), F.sum)


def largest(value: str | Column, name: str | None = None) -> Total:
    return Total(name or str(value), F.max(value), F.max)


def smallest(value: str | Column, name: str | None = None) -> Total:
    return Total(name or str(value), F.min(value), F.min)


def _values(column: str) -> Column:
    return F.size(F.collect_set(column)).cast("bigint")


def parts(df: DataFrame, keys: Sequence[str], totals: Sequence[Total], counted_columns: Sequence[str]) -> DataFrame:
    """Totals per key and combination of the counted columns: far fewer rows where values repeat."""
    return df.groupBy(*dict.fromkeys([*keys, *counted_columns])).agg(*[t.first() for t in totals])


def _by_size(
    df: DataFrame, keys: Sequence[str], limit: int, usual: Callable[[DataFrame], DataFrame], spread: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``usual`` over the groups that fit in one task, ``spread`` over those that a thin sample shows to be larger."""
    large = oversized_groups(df, keys, limit)
    if large.isEmpty():
        return usual(df)
    return usual(matching(df, large, keys, "left_anti")).unionByName(spread(matching(df, large, keys, "left_semi")))


def from_parts(
    reduced: DataFrame, keys: Sequence[str], totals: Sequence[Total], distinct: dict[str, str], limit: int = ONE_GROUP_ROWS
) -> DataFrame:
    """``parts`` put together per key, with exact distinct counts (output name to column). Expects written rows: they are counted first."""
    last = [t.last() for t in totals]
    usual = lambda df: df.groupBy(*keys).agg(*last, *[_values(c).alias(out) for out, c in distinct.items()])
    spread = lambda df: df.groupBy(*keys).agg(*last, *[F.count_distinct(c).alias(out) for out, c in distinct.items()])
    return usual(reduced) if reduced.count() <= limit else _by_size(reduced, keys, limit, usual, spread)


def totals_and_distinct(
    df: DataFrame, keys: Sequence[str], totals: Sequence[Total], distinct: dict[str, str], limit: int = ONE_GROUP_ROWS
) -> DataFrame:
    """``totals`` per key plus exact distinct counts (output name to column).

    In one plain aggregate, Spark copies every row once per distinct column. Here
    each task gathers the values of a key as sets, so one scan and one
    shuffle do for all counts. A set is no larger than its group, and groups of more
    than ``limit`` rows take another way: their rows are first put together per key and
    combination of the counted values, and what is left is counted value by
    value, spread over all tasks. A thin sample of the keys finds these groups (it reads
    the key columns once more); it decides the way, never the result.
    """
    whole = [t.whole() for t in totals]
    return _by_size(
        df, keys, limit,
        lambda rows: rows.groupBy(*keys).agg(*whole, *[_values(c).alias(out) for out, c in distinct.items()]),
        lambda rows: parts(rows, keys, totals, list(distinct.values()))
        .groupBy(*keys)
        .agg(*[t.last() for t in totals], *[F.count_distinct(c).alias(out) for out, c in distinct.items()]),
    )
