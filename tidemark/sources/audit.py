"""Load audit, the gate before a state change, and post-load verification."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.sources.files import BAD_ROW, stage


class SyncError(RuntimeError):
    """The sync state must not move forward."""


def _counts() -> list[Column]:
    bad = F.col(BAD_ROW).isNotNull()
    return [
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count_if(~bad).alias("rows_loaded"),
        F.count_if(bad).alias("errors_seen"),
        F.min(BAD_ROW).alias("first_error"),
    ]


def audit(loaded: DataFrame) -> DataFrame:
    """One row: status, rows parsed / loaded / errored and the first bad line. Expects staged rows."""
    counted = loaded.agg(*_counts())
    status = (
        F.when(F.col("errors_seen") == 0, "loaded")
        .when(F.col("rows_loaded") > 0, "partially_loaded")
        .otherwise("load_failed")
    )
    return counted.select(status.alias("status"), "rows_parsed", "rows_loaded", "errors_seen", "first_error")


@dataclass(frozen=True)
class LoadResult:
    status: str
    rows_parsed: int
    rows_loaded: int
    errors_seen: int
    first_error: str | None


def read_audit(audit_row: DataFrame) -> LoadResult:
    return LoadResult(**audit_row.first().asDict())


def stage_audited(loaded: DataFrame, path: str) -> tuple[DataFrame, LoadResult]:
    """Parse once into Parquet like ``stage``, with the audit counted by the write itself."""
    seen = Observation()
    staged = stage(loaded.observe(seen, *_counts()), path)
    counts = seen.get
    good, bad = counts["rows_loaded"], counts["errors_seen"]
    status = "loaded" if bad == 0 else "partially_loaded" if good else "load_failed"
    return staged, LoadResult(status, counts["rows_parsed"], good, bad, counts["first_error"])


def gate(result: LoadResult, rows_expected: int | None = None) -> LoadResult:
    """Raise unless the load was clean and not empty."""
    if rows_expected == 0:
        raise SyncError("the changed workouts hold no sets; the document shape may have changed")
    if result.errors_seen or result.status != "loaded":
        raise SyncError(
            f"{result.errors_seen} of {result.rows_parsed} rows failed; state kept. First: {result.first_error}"
        )
    if result.rows_loaded == 0:
        raise SyncError("no row was loaded; state kept")
    return result


def verify(df: DataFrame, column: str = "title") -> tuple[DataFrame, DataFrame]:
    """(total row count, distinct values in order)."""
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    return total, df.select(column).distinct().orderBy(column)
