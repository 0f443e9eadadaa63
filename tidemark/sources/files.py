"""File readers and writers: exports, JSON lines, seeds."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import text_to_whole
from tidemark.sources import schemas

# The texts that mean NULL in an export.
NULL_TEXTS = ["", "NULL", "null"]
BAD_ROW = "_corrupt_record"
# A compressed file of JSON lines holds up to this many.
FILE_ROWS = 500_000


def with_bad_row(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType())])


def load_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.EXPORT_TEXT,
    null_texts: Sequence[str] = tuple(NULL_TEXTS),
    source: str = "csv",
    integers: Sequence[str] = ("set_index",),
    line_breaks: bool | None = None,
) -> DataFrame:
    """Header-first, quoted CSV by position. Broken lines stay visible in ``_corrupt_record``.

    ``integers`` are cast after loading, so a bad number is a NULL in a good row.
    A file is read in splits unless one of its quoted texts holds a line break, as then
    it can only be parsed whole. By default a scan of the lines finds these files;
    ``line_breaks`` says it beforehand for all of them.
    """
    if line_breaks is None:
        whole = open_quoted_files(spark, path)
        raw = _read_csv(spark, path, schema, False)
        if whole:
            rest = sorted({_literal_path(f) for f in raw.inputFiles()} - set(whole))
            raw = _read_csv(spark, whole, schema, True)
            raw = raw.unionByName(_read_csv(spark, rest, schema, False)) if rest else raw
    else:
        raw = _read_csv(spark, path, schema, line_breaks)
    columns = []
    for f in schema.fields:
        value = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            value = F.when(~value.isin(*null_texts), value)
        if f.name in integers:
            value = text_to_whole(value)
        columns.append(value.alias(f.name))
    return raw.select(*columns, F.lit(source).alias("_source"), BAD_ROW)


def _read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, line_breaks: bool) -> DataFrame:
    return (
        spark.read.schema(with_bad_row(schema))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .csv(path)
    )


def _literal_path(listed: str) -> str:
    """A listed file's address as a path that names this file alone."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(re.sub("^([a-z0-9+.-]+):///", r"\1:/", listed)))


def open_quoted_files(spark: SparkSession, path: str) -> list[str]:
    """Files with a line of an odd number of quotes: a quoted text that goes on in the next line, or a broken one."""
    lines = spark.read.text(path).filter(F.regexp_count("value", F.lit('"')) % 2 == 1)
    found = lines.select(F.col("_metadata.file_path").alias("file")).distinct().collect()
    return sorted(_literal_path(r.file) for r in found)


def as_raw_sets(exported: DataFrame, loaded_at: datetime) -> DataFrame:
    """Export rows in the shape of the raw set table.

    An export has no session id: a digest of title and start time stands in.
    """
    key = F.md5(F.concat(F.coalesce("title", F.lit("")), F.coalesce("start_time", F.lit(""))))
    return exported.withColumn("workout_id", key).withColumn("_loaded_at", wall_clock(loaded_at))


def wall_clock(moment: datetime) -> Column:
    return F.lit(moment.replace(tzinfo=None)).cast("timestamp_ntz")


def load_jsonl(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW_SET) -> DataFrame:
    """One JSON object per line; a broken line is kept in ``_corrupt_record``."""
    return (
        spark.read.schema(with_bad_row(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .json(path)
    )


def stage(loaded: DataFrame, path: str) -> DataFrame:
    """Parse once into Parquet, broken lines included.

    Audit and load then read the same rows; a text source would be parsed again
    for each, and pruned columns would hide broken lines from the audit.
    """
    loaded.write.mode("overwrite").parquet(path, compression="zstd")
    return loaded.sparkSession.read.schema(loaded.schema).parquet(path)


def good_rows(loaded: DataFrame) -> DataFrame:
    return loaded.filter(F.col(BAD_ROW).isNull()).drop(BAD_ROW)


def run_path(base: str, run_ts: str) -> str:
    return f"{base.rstrip('/')}/workouts/incremental/{run_ts}"


def write_jsonl(df: DataFrame, base: str, run_ts: str) -> str:
    """Write to the folder of this run, compressed. A repeated run replaces its own folder only.

    A compressed file is read by one task, so its rows are bounded.
    """
    path = run_path(base, run_ts)
    writer = df.write.mode("overwrite").option("ignoreNullFields", False).option("maxRecordsPerFile", FILE_ROWS)
    writer.json(path, compression="gzip")
    return path


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Small typed CSV with a header; a wrong type fails the load."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


# Weekly set thresholds per muscle (muscle, movement group, low, middle, high).
LANDMARK_SEED = """\
muscle,movement_group,mev_sets,mav_sets,mrv_sets
chest,push,8,18,22
shoulders,push,8,20,26
triceps,push,6,14,18
lats,pull,8,16,22
upper_back,pull,8,16,25
biceps,pull,6,14,20
traps,pull,4,12,20
forearms,pull,4,12,20
quadriceps,legs,8,20,22
hamstrings,legs,6,16,20
glutes,legs,4,12,16
calves,legs,8,16,20
adductors,legs,0,8,12
abductors,legs,0,8,12
abdominals,core,6,16,25
lower_back,core,4,10,14
neck,other,0,8,12
cardio,other,,,
full_body,other,,,
other,other,,,
unknown,other,,,
"""


def default_landmarks(spark: SparkSession) -> DataFrame:
    lines = LANDMARK_SEED.strip().split("\n")[1:]
    text = spark.createDataFrame([(line,) for line in lines], "line string")
    parsed = F.from_csv("line", F.lit(schemas.LANDMARK.simpleString()[len("struct<"):-1].replace(":", " ")))
    return text.select(parsed.alias("r")).select("r.*")
