"""Tables in layered namespaces on shared storage.

A table is a folder of numbered versions and appended batches. Spark's committer
writes ``_SUCCESS`` last, so the newest version with that marker counts, and a
lost executor or driver leaves the old one in place. Before a version is written
its number is claimed by a file that must not exist yet, so two writers never
share a number; the file (its claim) names the schema, the batches the version
holds and the partition folders it takes over from earlier versions. The table is
the newest version and the batches it does not hold.

A written version never changes. ``swap`` writes the touched partitions as a new
version that takes over all others, so a reader sees the table before or after it,
and a swap that dies leaves the table as it was. Merges start from the version
they read: two that run at once do not see each other, and the later one counts.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordering import matching
from tidemark.session import scratch_path

# The layers and the raw tables that are read as sources.
LAYERS = ("bronze", "silver", "gold")
# Tables are written once and read by many: a dense codec.
CODEC = "zstd"
RAW_TABLES = ("raw_workouts", "raw_measurements", "dim_exercise_templates", "gym_locations")


def align_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """``target`` in the columns of ``batch``: new ones as NULL, vanished ones dropped."""
    have = set(target.columns)
    return target.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in batch.schema.fields
        ]
    )


def merge_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update matched keys, insert new ones, follow the batch's columns.

    The batch must hold each key once. A NULL key part matches a NULL.
    """
    aligned = align_columns(target, batch)
    return matching(aligned, batch, keys, "left_anti").unionByName(batch)


def replace_groups(target: DataFrame, rebuilt: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Swap whole groups: every target row of ``groups`` gives way to ``rebuilt``."""
    aligned = align_columns(target, rebuilt)
    return matching(aligned, groups, keys, "left_anti").unionByName(rebuilt)


def by_folder(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together per folder before a write; AQE splits a large folder and joins small ones.

    Without it every task would write a file into every folder.
    """
    return df.hint("rebalance", *partition_by)


@dataclass(frozen=True)
class Table:
    """One versioned table."""

    spark: SparkSession
    path: str

    def _names(self, below: str = "") -> list[str]:
        fs, root = _file_system(self.spark, self.path + below)
        return [status.getPath().getName() for status in fs.listStatus(root)] if fs.exists(root) else []

    def _complete(self, prefix: str) -> list[str]:
        """What follows ``prefix`` in the names of the completely written folders."""
        fs, root = _file_system(self.spark, self.path)
        path_of = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return [
            name[len(prefix) :]
            for name in self._names()
            if name.startswith(prefix) and fs.exists(path_of(root, f"{name}/_SUCCESS"))
        ]

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return sorted(int(v) for v in self._complete("v=") if v.isdigit())

    def exists(self) -> bool:
        return bool(self.versions() or self._complete("batch="))

    def _claimed(self, version: int) -> list[str]:
        """The lines of a version's claim: ``#`` schema, ``@`` folder taken over, else a batch."""
        fs, claim = _file_system(self.spark, f"{self.path}/_version={version}")
        if not fs.exists(claim):
            return []
        stream = fs.open(claim)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [line for line in text.split("\n") if line]

    def _held(self, version: int) -> set[str]:
        """The batches that a version holds."""
        return {line for line in self._claimed(version) if line[0] not in "#@"}

    def _layout(self, version: int) -> dict[str, int]:
        """Partition folder to the version it lies in; empty for a table without partitions."""
        taken = (line[3:].split("/", 1) for line in self._claimed(version) if line.startswith("@v="))
        own = {name: version for name in self._names(f"/v={version}") if "=" in name}
        return {name: int(owner) for owner, name in taken} | own

    def _state(self) -> tuple[int | None, list[str], set[str]]:
        """The newest version, the batches beside it, and all batches there are."""
        done, batches = self.versions(), set(self._complete("batch="))
        held = self._held(done[-1]) if done else set()
        return done[-1] if done else None, sorted(batches - held), batches

    def _claim(self, batches: set[str], lines: Sequence[str] = ()) -> int:
        """The next free version number, taken for this writer alone."""
        number = max(self.versions(), default=-1) + 1
        while True:
            fs, claim = _file_system(self.spark, f"{self.path}/_version={number}")
            if fs.exists(claim):  # another writer, or one that never finished
                number += 1
                continue
            try:
                stream = fs.create(claim, False)
            except Py4JJavaError:
                if not fs.exists(claim):
                    raise
                continue
            try:
                stream.write("\n".join([*lines, *sorted(batches)]).encode())
            finally:
                stream.close()
            return number

    def _version_rows(self, version: int) -> DataFrame:
        schemas = [T.StructType.fromJson(json.loads(line[1:])) for line in self._claimed(version) if line[0] == "#"]
        # With the schema at hand no footer is read, and folders of any version have the same types.
        reader = lambda: self.spark.read.schema(schemas[0]) if schemas else self.spark.read
        folders: dict[int, list[str]] = {}
        for name, owner in sorted(self._layout(version).items()):
            folders.setdefault(owner, []).append(f"{self.path}/v={owner}/{name}")
        if set(folders) <= {version}:
            return reader().parquet(f"{self.path}/v={version}")
        parts = [reader().option("basePath", f"{self.path}/v={owner}").parquet(*own) for owner, own in folders.items()]
        return reduce(DataFrame.unionByName, parts)

    def _rows(self, version: int | None, batches: Sequence[str]) -> DataFrame:
        parts = [self._version_rows(version)] if version is not None else []
        # Only batches in folders of the same column can be listed together.
        alike: dict[str, list[str]] = {}
        for b in batches:
            column = next((name.split("=")[0] for name in self._names(f"/batch={b}") if "=" in name), "")
            alike.setdefault(column, []).append(f"{self.path}/batch={b}")
        for column, folders in alike.items():
            reader = self.spark.read.option("mergeSchema", True)
            parts.append(reader.option("basePath", self.path).parquet(*folders).drop("batch") if column else reader.parquet(*folders))
        if not parts:
            raise FileNotFoundError(f"no complete version under {self.path}")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def read(self) -> DataFrame:
        """The newest version, if any, and all batches appended beside it."""
        version, batches, _ = self._state()
        return self._rows(version, batches)

    def _write(
        self,
        df: DataFrame,
        partition_by: Sequence[str],
        batches: set[str],
        taken: dict[str, int] | None = None,
        gather: bool = True,
    ) -> DataFrame:
        rows = by_folder(df, partition_by) if partition_by and gather else df
        writer = rows.write.mode("overwrite").partitionBy(*partition_by)
        lines = ["#" + df.schema.json(), *sorted(f"@v={owner}/{name}" for name, owner in (taken or {}).items())]
        number = self._claim(batches, lines)
        writer.parquet(f"{self.path}/v={number}", compression=CODEC)
        return self._version_rows(number)

    def replace(self, df: DataFrame, partition_by: Sequence[str] = (), gather: bool = True) -> DataFrame:
        """Full refresh as a new version in place of everything there is now. ``df`` may read the current one.

        ``gather=False`` writes each task's rows as they lie: no shuffle, but up to as many files as tasks times folders.
        """
        return self._write(df, partition_by, self._state()[2], gather=gather)

    def upsert(self, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
        """Merge into version and batches. Appended rows that share a key all give way to the merged row."""
        version, batches, every = self._state()
        if version is None and not batches:
            return self._write(batch, partition_by, every)
        # What is read and what the new version is said to hold come from one listing: a batch that lands meanwhile stays beside it.
        return self._write(merge_rows(self._rows(version, batches), batch, keys), partition_by, every)

    def compact(self, partition_by: Sequence[str] = ()) -> DataFrame:
        """Take all batches into one new version, so that reading no longer lists each of them."""
        version, batches, every = self._state()
        rows = self._rows(version, batches)
        return self._write(rows, partition_by, every) if batches else rows

    def swap(
        self, rebuilt: DataFrame, keys: Sequence[str], partition: str, groups: DataFrame | None = None, gather: bool = True
    ) -> DataFrame:
        """Replace whole key groups, rewriting only the partitions they lie in. Batches are taken in first.

        Every row whose key is in ``groups`` (by default: in ``rebuilt``) gives way
        to the rows of ``rebuilt``. Partition values must not be NULL and must read the same in
        a folder's name (numbers, dates, plain words). ``gather`` as in ``replace``.
        """
        version, batches, every = self._state()
        if version is None or batches:
            self._write(self._rows(version, batches), (partition,), every, gather=gather)
            version = self._state()[0]
        batch = _staged(rebuilt, "rebuilt")
        incoming = _staged((batch if groups is None else groups).select(*keys).distinct(), "groups")
        target = self._version_rows(version)
        losing = matching(target.select(*keys, partition), incoming, keys, "left_semi").select(partition)
        values = _values(losing.unionByName(batch.select(partition)), partition)
        if not values:
            return target
        affected = target.filter(F.col(partition).isin(values))
        merged = replace_groups(affected, batch.select(*target.columns), incoming, keys)
        touched = {f"{partition}={v}" for v in values}
        taken = {name: owner for name, owner in self._layout(version).items() if name not in touched}
        return self._write(merged, (partition,), self._held(version), taken, gather)

    def forget(self, keep: int) -> None:
        """Remove all but the newest ``keep`` complete versions, and the batches that all of these hold.

        Folders that a kept version takes over stay.
        """
        kept = self.versions()[-keep:]
        needed = {(owner, name) for v in kept for name, owner in self._layout(v).items()}
        numbers = (int(n[2:]) for n in self._names() if n.startswith("v=") and n[2:].isdigit())
        for version in sorted(n for n in numbers if kept and n < kept[0]):
            # First of all it is no complete version any more.
            remove_folder(self.spark, f"{self.path}/v={version}/_SUCCESS")
            names = self._names(f"/v={version}")
            if any((version, name) in needed for name in names):
                for name in names:
                    if (version, name) not in needed:
                        remove_folder(self.spark, f"{self.path}/v={version}/{name}")
                continue
            remove_folder(self.spark, f"{self.path}/v={version}")
            remove_folder(self.spark, f"{self.path}/_version={version}")
        held = [self._held(v) for v in kept]
        for batch in set.intersection(*held) if held else ():
            remove_folder(self.spark, f"{self.path}/batch={batch}")

    def append_batch(self, df: DataFrame, batch_id: int | str, partition_by: Sequence[str] = ()) -> None:
        """Add one batch to an append-only table; repeating a batch replaces it.

        A name must be unique over all streams that write here. A batch that the
        current version already holds is not written again. In a table whose batches lie in
        folders no column may be named ``batch``.
        """
        version, _, _ = self._state()
        if version is None or str(batch_id) not in self._held(version):
            rows = by_folder(df, partition_by) if partition_by else df
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.path}/batch={batch_id}", compression=CODEC)


@dataclass(frozen=True)
class Catalog:
    """Layer and name to table; one folder per layer."""

    spark: SparkSession
    root: str

    def table(self, layer: str, name: str) -> Table:
        if layer.lower() not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return Table(self.spark, f"{self.root.rstrip('/')}/{layer.lower()}/{name}")

    def source(self, name: str, folders: bool = False) -> DataFrame:
        """A raw table; with ``folders`` also the column of its session folders, if it has them."""
        if name not in RAW_TABLES:
            raise ValueError(f"{name!r} is not a declared source")
        rows = self.table("bronze", name).read()
        return rows if folders else rows.drop(*session_columns(rows.columns))

    def materialise(
        self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = (), gather: bool = True
    ) -> DataFrame:
        return self.table(layer, name).replace(df, partition_by, gather)


# ---- raw rows by session ---------------------------------------------------------------------

SESSION_FOLDERS = 64
_FOLDER = re.compile(r"part_session_(\d+)")


def _session_folder(folders: int) -> Column:
    return F.pmod(F.xxhash64("workout_id"), F.lit(folders)).cast("int")


def by_session(raw: DataFrame, folders: int = SESSION_FOLDERS) -> DataFrame:
    """``raw`` with its session folder, a hash of the session id; the column's name says how many there are.

    Written in such folders, the table is read only where touched sessions lie. Take enough of
    them that the sessions of one load do not fall into all.
    """
    return raw.withColumn(f"part_session_{folders}", _session_folder(folders))


def session_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if _FOLDER.fullmatch(c)]


def in_folders_of(raw: DataFrame, sessions: DataFrame) -> DataFrame:
    """The rows of ``raw`` in the folders of ``sessions``, and rows without a folder.

    The folders of the few touched sessions go to the driver (no more than the table has) and come
    back as literals, so the scan leaves all other folders out.
    """
    for name in session_columns(raw.columns):
        folders = int(_FOLDER.fullmatch(name)[1])
        touched = [r[0] for r in sessions.select(_session_folder(folders)).distinct().collect()]
        raw = raw.filter(F.col(name).isNull() | F.col(name).isin(touched))
    return raw.drop(*session_columns(raw.columns))


def _staged(df: DataFrame, label: str) -> DataFrame:
    """Computed once, in the shared folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _values(df: DataFrame, partition: str) -> list:
    """The distinct partition values, one per folder of the table."""
    return [r[0] for r in df.select(partition).distinct().collect()]


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def stable_id(spark: SparkSession, folder: str) -> str:
    """An id kept in a folder: the same for its life, another one after it is lost."""
    fs, path = _file_system(spark, f"{folder}/_stream_id")
    if not fs.exists(path):
        stream = fs.create(path, False)
        stream.write(uuid.uuid4().hex[:12].encode())
        stream.close()
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# ---- change windows ----------------------------------------------------------------------------


def high_water(target: DataFrame, column: str):
    """Largest value of a column (one row to the driver); None for an empty table."""
    return target.agg(F.max(column)).first()[0]


def _after(df: DataFrame, value: Column, mark) -> DataFrame:
    """Rows above the mark. Against an empty target nothing is newer: MAX is NULL."""
    return df.filter(value > F.lit(mark)) if mark is not None else df.filter(F.lit(False))


def since_loaded(df: DataFrame, target: DataFrame, column: str = "_loaded_at") -> DataFrame:
    """Rows loaded after the newest load in ``target``.

    The mark is read first and used as a literal, so Parquet row groups and
    partitions below it are skipped.
    """
    return _after(df, F.col(column), high_water(target, column))


def since_event(df: DataFrame, target: DataFrame, value: Column, column: str) -> DataFrame:
    """Rows dated after the newest event in ``target``; a late edit of an old event is missed."""
    return _after(df, value, high_water(target, column))


def since_updated(df: DataFrame, mark, column: str = "updated_at") -> DataFrame:
    """Rows changed after ``mark``, whatever order they arrive in."""
    return df.filter(F.col(column) > F.lit(mark))
