"""Dimension, range and date lookups.

No side is force-broadcast: Spark broadcasts a dimension when its size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where AQE
splits a hot key of the fact side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bins that ranges are cut into: 32 days wide at the lowest level, 8 times wider at each further one.
BIN_BITS = 5
LEVEL_BITS = 3
LEVELS = 7
# The list of bins may be broadcast up to this many rows.
BROADCAST_ROWS = 500_000


def _bin(day: Column, level: int) -> Column:
    return F.shiftright(F.unix_date(day), BIN_BITS + LEVEL_BITS * level)


def range_bins(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Each range under the few bins that make it up: ``_level`` and ``_bin``, as in a segment tree.

    Bins at the ends may reach beyond the range. At each level whole blocks of eight bins go to the next
    one, so a range takes at most fifteen bins a level, however long it is.
    """
    step = 1 << LEVEL_BITS
    bins = "array<struct<level:int,bin:int>>"

    def listed(a: Column, b: Column, level: Column) -> Column:
        each = F.transform(F.sequence(a, F.greatest(a, b)), lambda n: F.struct(level.alias("level"), n.alias("bin")))
        return F.when(a <= b, each).otherwise(F.array().cast(bins))

    def climb(state: Column, level: Column) -> Column:
        low, high = state["low"], state["high"]
        first, last = F.floor((low + (step - 1)) / step).cast("int"), (F.floor((high + 1) / step) - 1).cast("int")
        up = (first <= last) & (level < LEVELS - 1)
        split = F.concat(listed(low, first * step - 1, level), listed((last + 1) * step, high, level))
        # Nothing is left for the next level once a range does not hold a whole block.
        return F.struct(
            F.when(up, first).otherwise(1).alias("low"), F.when(up, last).otherwise(0).alias("high"),
            F.concat(state["bins"], F.when(up, split).otherwise(listed(low, high, level))).alias("bins"),
        )

    begin = F.struct(_bin(F.col(start), 0).alias("low"), _bin(F.col(end), 0).alias("high"), F.array().cast(bins).alias("bins"))
    every = F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), begin, climb, lambda state: state["bins"])
    real = ranges.filter(F.col(start) <= F.col(end))
    return real.select(*ranges.columns, F.inline(every).alias("_level", "_bin"))


def range_lookup(
    facts: DataFrame,
    ranges: DataFrame,
    day: str,
    take: Sequence[str],
    entity: Sequence[str] = (),
    start: str = "start_date",
    end: str = "end_date",
    days: DataFrame | None = None,
) -> DataFrame:
    """Left join on ``day BETWEEN start AND end``, inclusive; overlaps fan rows out.

    Each range is listed under the bins that make it up (``range_bins``), which makes
    the join an equi-join on (entity, bin) with the exact bounds as residual condition.
    Ranges of less than 256 days have bins of one level only, and the facts
    meet the list directly. With longer ranges, such as those with an open end, the distinct days of
    the facts look their bins up at every level in use, and the facts meet the
    result by day; ``days`` may give these days (entity and day columns, more than
    there are do no harm) where reading the facts twice is dear.

    Spark estimates the list by the size of the unlisted ranges; a list that is long
    in fact is therefore counted and kept from being broadcast.
    """
    renamed = ranges.select(
        *[F.col(k).alias(f"_r_{k}") for k in entity],
        F.col(start).cast("date").alias("_r_start"),
        F.col(end).cast("date").alias("_r_end"),
        *[F.col(c).alias(f"_r_{c}") for c in take],
    )
    listed = range_bins(renamed, "_r_start", "_r_end")
    if listed.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        listed = listed.hint("merge")
    levels = [r[0] for r in listed.select("_level").distinct().collect()]
    taken = [F.col(f"_r_{c}").alias(f"range_{c}") for c in take]

    def match(rows: DataFrame, bin_of: Column) -> Column:
        same = (bin_of == listed["_bin"]) & rows[day].between(listed["_r_start"], listed["_r_end"])
        for k in entity:
            same = same & (rows[k] == listed[f"_r_{k}"])
        return same

    if len(levels) <= 1:
        return facts.join(listed, match(facts, _bin(facts[day], levels[0] if levels else 0)), "left").select(*facts.columns, *taken)
    asked = (facts if days is None else days).select(*entity, day).distinct()
    bins = F.inline(F.array(*[F.struct(F.lit(n).alias("_in_level"), _bin(F.col(day), n).alias("_in_bin")) for n in sorted(levels)]))
    probes = asked.select("*", bins)
    same = match(probes, probes["_in_bin"]) & (probes["_in_level"] == listed["_level"])
    found = probes.join(listed, same).select(
        *[F.col(k).alias(f"_f_{k}") for k in entity], F.col(day).alias("_f_day"), *[F.col(f"_r_{c}") for c in take]
    )
    on = facts[day] == found["_f_day"]
    for k in entity:
        on = on & (facts[k] == found[f"_f_{k}"])
    return facts.join(found, on, "left").select(*facts.columns, *taken)


def caseless_lookup(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, take: dict[str, str]
) -> DataFrame:
    """Left join on the lower-cased key; ``take`` maps dimension columns to output names."""
    side = dim.select(
        F.lower(F.col(dim_key)).alias("_d_key"), *[F.col(c).alias(f"_d_{c}") for c in take]
    )
    joined = facts.join(side, F.lower(facts[fact_key]) == side["_d_key"], "left")
    return joined.select(
        *facts.columns,
        *[F.col(f"_d_{c}").alias(out) for c, out in take.items()],
        F.col("_d_key").isNull().alias("_unmatched"),
    )


def day_lookup(
    facts: DataFrame, daily: DataFrame, take: Sequence[str], entity: Sequence[str] = (), day: str = "workout_date"
) -> DataFrame:
    """Attach the attributes of the same entity and day."""
    keys = [*entity, day]
    return facts.join(daily.select(*keys, *take), keys, "left")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose value has no parent; a NULL value is not an orphan."""
    known = parent.select(F.col(parent_column).alias("_p")).distinct()
    return child.filter(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_p"), "left_anti")
