"""Key/value sync state on shared storage."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

from tidemark.sources.audit import SyncError
from tidemark.sources.tables import Table

STATE_SCHEMA = "key string, value string"
# The state key of the workout sync and the reach of a first run.
WORKOUT_SYNC = "last_workout_sync"
FIRST_RUN_DAYS = 7


@dataclass(frozen=True)
class SyncState:
    spark: SparkSession
    path: str

    @property
    def table(self) -> Table:
        return Table(self.spark, self.path)

    def ensure(self) -> None:
        if not self.table.exists():
            self.table.replace(self.spark.createDataFrame([], STATE_SCHEMA).coalesce(1))

    def get(self, key: str = WORKOUT_SYNC) -> datetime | None:
        """None on a first run; a value that is no timestamp is an error, not a first run."""
        self.ensure()
        row = self.table.read().filter(f"key = '{key}'").first()
        if row is None or row["value"] is None:
            return None
        try:
            return datetime.fromisoformat(row["value"])
        except ValueError as e:
            raise SyncError(f"state {key!r} holds {row['value']!r}, which is no timestamp") from e

    def set(self, moment: datetime, key: str = WORKOUT_SYNC) -> None:
        self.ensure()
        row = self.spark.createDataFrame([(key, moment.isoformat())], STATE_SCHEMA)
        self.table.upsert(row.coalesce(1), ["key"])
        self.table.forget(keep=10)


def sync_window(state: SyncState, now: datetime | None = None) -> tuple[datetime, datetime]:
    """(from, to). ``to`` is taken before anything is read; a first run looks back 7 days."""
    started = now or datetime.now(timezone.utc)
    return state.get() or started - timedelta(days=FIRST_RUN_DAYS), started
