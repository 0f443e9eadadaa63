"""Document assembly and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import fingerprint, is_blank
from tidemark.operators.ordering import first_seen


def assemble(df: DataFrame, key: str, title: str, parts: str, url_prefix: str, url_suffix: str = "/") -> DataFrame:
    """Title and body in one text; records whose parts are all blank are dropped.

    ``parts`` is an array of strings, joined by one blank.
    """
    body = F.array_join(F.coalesce(F.col(parts), F.array().cast("array<string>")), " ")
    return (
        df.withColumn("abstract", body)
        .filter(~is_blank(F.col("abstract")))
        .withColumn("content", F.concat(F.coalesce(F.col(title), F.lit("")), F.lit("\n\n"), F.col("abstract")))
        .withColumn("source_url", F.concat(F.lit(url_prefix), F.col(key).cast("string"), F.lit(url_suffix)))
    )


def first_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One document per key: the first in query order."""
    return first_seen(df, [key], order)


def equal_text_groups(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Texts equal up to case and white space: the lowest id and the number of copies.

    Grouping runs on a digest with a partial count per task, so a text copied
    into a third of all rows still arrives as one row per task.
    """
    return df.groupBy(fingerprint(F.col(text)).alias("fingerprint")).agg(
        F.min(doc_id).alias("keeper"), F.count(F.lit(1)).alias("copies")
    )


def drop_equal_texts(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows that are the lowest id of their text.

    Only the texts that occur more than once take part in the join, and only
    ids travel: a row is dropped if its id is among the ids to drop.
    """
    prints = df.select(F.col(doc_id).alias("_id"), fingerprint(F.col(text)).alias("fingerprint"))
    several = equal_text_groups(df, doc_id, text).filter("copies > 1").select("fingerprint", "keeper")
    dropped = prints.join(several, "fingerprint").filter("_id <> keeper").select("_id").distinct()
    return df.join(dropped, F.col(doc_id) == F.col("_id"), "left_anti")
