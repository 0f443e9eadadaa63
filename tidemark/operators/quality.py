"""Data-quality checks. Each returns the violating rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.calendar import series_window
from tidemark.operators.lookup import orphans
from tidemark.session import scratch_path


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys held by more than one row. A single NULL key is not a duplicate value."""
    rows = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def repeated_keys(df: DataFrame, checks: dict[str, Sequence[str]]) -> DataFrame:
    """(check_name, violations): how many keys of each check more than one row holds, as ``unique`` counts them.

    One scan of the table serves all checks: it gives a row (check, hash of the key)
    per check, which tasks count before the shuffle. Only where a hash occurs twice is
    the table read again, and the full keys of these few rows are counted.
    """
    names = list(checks)
    spark = df.sparkSession

    def stacked(*columns: str) -> DataFrame:
        each = []
        for n, name in enumerate(names):
            keys = checks[name]
            counts = F.col(keys[0]).isNotNull() if len(keys) == 1 else F.lit(True)
            full = F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]))
            each.append(F.struct(F.lit(n).alias("check"), F.when(counts, F.xxhash64(*keys)).alias("hash"), full.alias("key")))
        return df.select(F.inline(F.array(*each))).filter("hash IS NOT NULL").select(*columns)

    twice = stacked("check", "hash").groupBy("check", "hash").count().filter("count > 1").select("check", "hash")
    path = scratch_path(spark, "repeated")
    twice.write.parquet(path)
    twice = spark.read.schema(twice.schema).parquet(path)
    every = spark.createDataFrame([(n, name) for n, name in enumerate(names)], "check int, check_name string")
    if twice.isEmpty():
        return every.select("check_name", F.lit(0).cast("bigint").alias("violations"))
    held = stacked("check", "hash", "key").join(twice, ["check", "hash"], "left_semi")
    bad = held.groupBy("check", "hash", "key").count().filter("count > 1").groupBy("check").agg(F.count(F.lit(1)).alias("violations"))
    return every.join(bad, "check", "left").select("check_name", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their row counts; NULL is left to ``not_null``."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return orphans(df, column, parent, parent_column)


def no_gaps(df: DataFrame, entity: Sequence[str], day: str) -> DataFrame:
    """Rows whose predecessor is not exactly one day earlier. Expects one row per entity and day."""
    before = F.lag(day).over(series_window(entity, day))
    return (
        df.select(*entity, day, before.alias("prev_date"))
        .withColumn("gap_days", F.datediff(F.col(day), F.col("prev_date")))
        .filter("prev_date IS NOT NULL AND gap_days <> 1")
    )


def in_range(df: DataFrame, column: str, low: float, high: float, keep: Sequence[str]) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high)).select(*keep, column)


def failing_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check_name, violations) for conditions that mark a bad row, all in one scan."""
    names = list(checks)
    counted = df.agg(*[F.count_if(checks[n]).alias(f"c{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(names)])
    return counted.select(F.inline(pairs))


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per check with its number of violating rows."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)
