"""Spark session and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """UTC session with AQE (coalescing and skew-join splitting) switched on.

    ANSI mode stays at Spark's default, so every division in the library goes
    through a NULL-on-zero helper and every text cast through ``try_cast``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a fresh folder on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df):
    """Cut lineage through the shared folder, so losing an executor costs no recompute."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
