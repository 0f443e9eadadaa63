"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: a lost executor costs no recompute."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting by which a query's shuffle files go at its end, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def released(df: DataFrame, label: str) -> DataFrame:
    """As ``stored`` with denser files, and the shuffle files of the write go at its end."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return stored(df, label, compression="zstd")
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole row as the struct ``row`` beside the columns in use, so that no other name of it can clash."""
    return docs.select(*columns, F.struct("*").alias("row"))


def labelled_sample(labels: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """At most ``rows`` labelled ids with one value per label column.

    Rows without an id or with a NULL label are no examples. Of repeated ids the
    largest label counts. The choice follows a hash of the id, so it is the same
    in every run. ``rows`` bounds the result, and with it what is broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("int").alias(c) for c in columns])
    one = known.na.drop().groupBy("doc_id").agg(*[F.max(c).alias(c) for c in columns])
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The sampled documents with their labels; the sample has a bounded size and is broadcast."""
    own = docs.select(F.col("doc_id"), F.col("text"))
    return own.join(F.broadcast(sample), "doc_id")
