"""Spark session set-up and the folder that jobs share for materialised intermediate data."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "tallymart", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on and times in UTC; ``settings`` are extra Spark settings."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder: on a cluster
    a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallymart-"))
    return context.getCheckpointDir()


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within it, the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.

    For jobs of many queries whose results are stored: a DataFrame that is made here and run twice shuffles twice.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def checkpointed(df):
    """``df`` materialised in reliable storage, so that its partitioning and row placement stay fixed."""
    folder, context = shared_dir(df.sparkSession), df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def settled(df, few: int = 10_000):
    """``df`` as fixed rows: a result of at most ``few`` rows comes to the driver and back, a larger one is checkpointed."""
    rows = df.limit(few + 1).collect()
    return df.sparkSession.createDataFrame(rows, df.schema) if len(rows) <= few else checkpointed(df)
