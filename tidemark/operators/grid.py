"""Complete grids: every period against every member of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension up to this many rows is carried along as an array literal.
INLINE_ROWS = 200


def complete_grid(periods: DataFrame, members: DataFrame, key: Sequence[str]) -> DataFrame:
    """All pairs of a period row and a member row (the product is the result itself).

    A short member list becomes an array per row and is exploded in place. A
    longer one is spread over buckets and met by an equi-join, so neither side
    has to fit in one task.
    """
    head = members.limit(INLINE_ROWS + 1).collect()
    if head and len(head) <= INLINE_ROWS:
        listed = F.array(
            *[
                F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in members.schema.fields])
                for row in head
            ]
        )
        return periods.withColumn("_m", F.explode(listed)).select(*periods.columns, "_m.*")

    buckets = max(2, int(periods.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = members.withColumn("_b", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    copied = periods.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return copied.join(spread, "_b").drop("_b")
