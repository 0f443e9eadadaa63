"""Change events from a landing folder into the raw set table.

The stream's checkpoint remembers which files were read; a batch that fails its
gate stops the stream before the checkpoint moves, so the next run repeats it.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources import schemas
from tidemark.sources.audit import gate, stage_audited
from tidemark.sources.documents import flatten_workouts, split_events
from tidemark.sources.files import BAD_ROW, good_rows, load_jsonl, wall_clock, with_bad_row, write_jsonl
from tidemark.sources.state import SyncState, sync_window
from tidemark.sources.tables import Table, by_session, remove_folder, session_columns, since_updated, stable_id


def event_stream(spark: SparkSession, landing: str, schema: StructType = schemas.EVENT_DOC) -> DataFrame:
    """Landed change events, one JSON object per line; broken lines stay visible."""
    return (
        spark.readStream.schema(with_bad_row(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .json(landing)
    )


def load_batch(bronze: Table, loaded_at: datetime, stream: str, keep: tuple[str, ...] = ()):
    """The ``foreachBatch`` step: split, flatten, gate, append.

    The batch is written under the stream's and its own id; a retried batch
    overwrites its own rows, so every event lands once however often it is
    attempted, and another stream into the same table never meets it.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        name = f"{stream}-{batch_id}"
        at = f"{bronze.path}.staged/batch={name}"
        staged, result = stage_audited(batch, at)
        if result.rows_parsed == 0:
            return
        changed, _ = split_events(good_rows(staged))
        rows = by_session(flatten_workouts(changed, keep).withColumn("_loaded_at", wall_clock(loaded_at)))
        has_changes = not changed.isEmpty()
        gate(result, rows_expected=0 if has_changes and rows.isEmpty() else None)
        if has_changes:
            bronze.append_batch(rows, name, session_columns(rows.columns))
        remove_folder(batch.sparkSession, at)  # a refused batch keeps its staged rows for inspection

    return step


def run_sync(
    spark: SparkSession,
    landing: str,
    bronze: Table,
    state: SyncState,
    checkpoint: str,
    now: datetime | None = None,
    schema: StructType = schemas.EVENT_DOC,
    keep: tuple[str, ...] = (),
) -> datetime:
    """Read everything that has landed, then move the sync state to the run's start time.

    ``keep`` names entity fields of the workout, which ``schema`` must then list.
    The start time is taken before reading. A run without new files also moves
    the state; a refused batch raises and leaves it.
    """
    started = now or datetime.now(timezone.utc)
    state.ensure()
    query = (
        event_stream(spark, landing, schema)
        .writeStream.foreachBatch(load_batch(bronze, started, stable_id(spark, checkpoint), keep))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    state.set(started)
    return started


def drop_repeated(events: DataFrame, key: str, at: str, within: str) -> DataFrame:
    """Stream without the repeats of a key that arrive within the given delay.

    ``at`` may be a wall-clock time; a watermark needs an instant, so it is read
    in the session's time zone. Repeats over a longer time are left to the set
    plan, which collapses exact copies whenever they were loaded.
    """
    return (
        events.withColumn("_at", F.col(at).cast("timestamp"))
        .withWatermark("_at", within)
        .dropDuplicatesWithinWatermark([key])
        .drop("_at")
    )


def _changed_since(workouts: DataFrame, since: datetime) -> DataFrame:
    """Workouts changed after ``since``; a change time that cannot be read fails the run.

    A dropped workout would be lost for good, as the state moves past it. The
    test sits in the filter, so it costs no pass of its own and no row escapes it.
    """
    read = F.try_to_timestamp(F.col("updated_at"))
    checked = F.when(read.isNotNull(), read).otherwise(
        F.raise_error(F.concat(F.lit("workout without a readable change time: "), F.coalesce(F.col("updated_at").cast("string"), F.lit("NULL")))).cast("timestamp")
    )
    return since_updated(workouts.withColumn("_changed", checked), since, "_changed")


def fallback_sync(workouts: DataFrame, since: datetime) -> DataFrame:
    """Set rows of the workouts changed after ``since``, when no change events exist."""
    return flatten_workouts(_changed_since(workouts, since))


def run_window_sync(
    workouts: DataFrame, bronze: Table, held: SyncState, now: datetime | None = None
) -> tuple[datetime, datetime]:
    """One sync over a window of change times, kept in the sync state.

    The window ends where the run began and starts at the last good run, or 7
    days back on a first run. The state moves only after a clean load, or when
    nothing changed. The batch is named after the state's stream and the window's
    end, so a repeated run replaces its own rows and no other stream's.
    """
    since, started = sync_window(held, now)
    changed = _changed_since(workouts, since)
    if not changed.isEmpty():
        # Two streams into one table may start in the same second.
        stream, run_ts = stable_id(workouts.sparkSession, held.path), started.strftime("%Y%m%d_%H%M%S")
        landed = write_jsonl(flatten_workouts(changed), f"{bronze.path}.landed/{stream}", run_ts)
        at = f"{bronze.path}.staged/{stream}-{run_ts}"
        staged, result = stage_audited(load_jsonl(workouts.sparkSession, landed), at)
        gate(result, rows_expected=result.rows_parsed)
        rows = by_session(good_rows(staged).withColumn("_loaded_at", wall_clock(started)))
        bronze.append_batch(rows, f"{stream}-{run_ts}", session_columns(rows.columns))
        remove_folder(workouts.sparkSession, at)
    held.set(started)
    return since, started
