"""Row picking and numbering inside groups that may be very large."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import reliable_checkpoint, scratch_path

# A group up to this many rows is numbered by one task.
ONE_TASK_ROWS = 4_000_000


def total_order(df: DataFrame, lead: Sequence[Column], skip: Sequence[str] = ()) -> list[Column]:
    """``lead`` followed by every other column, so that ties never pick at random."""
    return [*lead, *(F.col(c).asc_nulls_last() for c in df.columns if c not in skip)]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each map task to one row per key before the shuffle
    (WindowGroupLimit), so many copies of one key do not pile up in a task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pick", F.row_number().over(w)).filter("_pick = 1").drop("_pick")


def collapse_duplicates(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Keep the most recently loaded of the rows that agree on ``keys``."""
    order = total_order(df, [F.col(newest).desc_nulls_last()], skip=[*keys, newest])
    return keep_first(df, keys, order)


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first occurrence of each key in an explicit order."""
    return keep_first(df, keys, total_order(df, [F.col(c).asc_nulls_last() for c in order], skip=[*keys, *order]))


def oversized_groups(
    df: DataFrame, keys: Sequence[str], limit: int = ONE_TASK_ROWS, fraction: float | None = None
) -> DataFrame:
    """Keys whose groups look larger than ``limit`` rows.

    A thin sample of the key columns suffices: a group that large leaves
    thousands of sampled rows. It only chooses how a group is numbered, never
    which rows are kept, so a miss costs time and not correctness. The sample is
    taken once and written to the shared folder: all that ask later see the same
    groups. ``_rows`` estimates their sizes.
    """
    fraction = fraction if fraction is not None else min(1.0, 4_000 / limit)
    picked = df.select(*keys)
    if fraction < 1.0:
        picked = picked.sample(fraction, seed=7)
    sizes = picked.groupBy(*keys).count()
    large = sizes.filter(F.col("count") > limit * fraction * 0.5).withColumn("_rows", (F.col("count") / fraction).cast("long")).drop("count")
    path = scratch_path(df.sparkSession, "oversized")
    large.write.parquet(path)
    return df.sparkSession.read.schema(large.schema).parquet(path)


def matching(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows of ``df`` with (``left_semi``) or without (``left_anti``) a row in ``groups``.

    Two NULL key parts are equal, as they are in a grouping.
    """
    side = groups.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = reduce(Column.__and__, [df[k].eqNullSafe(side[f"_k_{k}"]) for k in keys])
    return df.join(side, same, how)


# Stands between two values of a row that travels as text; inside of a value the escape leads what stands for both, for NULL and for hex.
_BETWEEN, _ESCAPE = "\x01", "\x02"
_NULL = _ESCAPE + "n"


def _fits_in_text(kind: T.DataType) -> bool:
    return kind == T.StringType() or isinstance(kind, (T.IntegralType, T.BooleanType, T.DateType, T.DecimalType, T.TimestampType))


def gathered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df.repartition(*keys)`` with the other columns of a row sent as one text.

    A shuffled row spends eight bytes and more on every column, the text only what its values need: rows of
    many short columns take about half. Values come back exactly as they were, NULL and empty texts told
    apart. Times travel as microseconds; columns of other types (fractions, lists) as they are.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    sent = [c for c, kind in kinds.items() if c not in keys and _fits_in_text(kind)]
    if len(sent) < 2:
        return df.repartition(*keys)

    def written(c: str) -> Column:
        text = (F.unix_micros(c) if kinds[c] == T.TimestampType() else F.col(c)).cast("string")
        if kinds[c] == T.StringType():
            escaped = F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_BETWEEN), F.lit(_ESCAPE + "a"))
            # Splitting a text would change bytes that are no UTF-8.
            text = F.when(F.is_valid_utf8(text), escaped).otherwise(F.concat(F.lit(_ESCAPE + "h"), F.hex(text)))
        return F.coalesce(text, F.lit(_NULL))

    def value(c: str) -> Column:
        text = F.split_part("_sent", F.lit(_BETWEEN), F.lit(sent.index(c) + 1))
        text = F.when(text != _NULL, text)
        if kinds[c] == T.StringType():
            raw = F.replace(F.replace(text, F.lit(_ESCAPE + "a"), F.lit(_BETWEEN)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE))
            return F.when(text.startswith(_ESCAPE + "h"), F.unhex(F.substr(text, F.lit(3))).cast("string")).otherwise(raw)
        return F.timestamp_micros(text.cast("bigint")) if kinds[c] == T.TimestampType() else text.cast(kinds[c])

    others = [c for c in df.columns if c not in sent]
    rows = df.select(*others, F.concat_ws(_BETWEEN, *[written(c) for c in sent]).alias("_sent")).repartition(*keys)
    return rows.select(*[value(c).alias(c) if c in sent else F.col(c) for c in df.columns])


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    oversized: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """``row_number`` per key, also for groups too large for one task.

    Pass ``oversized_groups(...)`` to have those groups cut into ranges of the
    order: rows are numbered inside a range, and the sizes of the earlier ranges
    are added. The cut is written out once, so a retry cannot move it.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    if oversized is None or oversized.isEmpty():
        return df.withColumn(name, F.row_number().over(w))

    usual = matching(df, oversized, keys, "left_anti").withColumn(name, F.row_number().over(w))

    spark = df.sparkSession
    # Twice as many ranges as full tasks: the groups' sizes are estimates.
    rows = oversized.agg(F.sum("_rows")).first()[0]
    slices = slices or 2 * -(-rows // ONE_TASK_ROWS)
    cut = matching(df, oversized, keys, "left_semi").repartitionByRange(slices, *[F.col(k) for k in keys], *order)
    cut = reliable_checkpoint(cut.withColumn("_slice", F.spark_partition_id()))

    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per key and range it touches: the number of ranges bounds this table.
    offsets = (
        cut.groupBy(*keys, "_slice")
        .count()
        .withColumn("_before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_off_{k}") for k in keys], F.col("_slice").alias("_off_slice"), "_before")
    )
    numbered = cut.withColumn(name, F.row_number().over(inside))
    same = [numbered[k].eqNullSafe(offsets[f"_off_{k}"]) for k in keys]
    match = reduce(Column.__and__, same, numbered["_slice"] == offsets["_off_slice"])
    big = numbered.join(offsets, match).withColumn(name, (F.col(name) + F.col("_before")).cast("int"))
    return usual.unionByName(big.select(*usual.columns))


def top_rows(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """Report cut: ordered rows up to ``limit`` (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(limit)
