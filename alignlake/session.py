"""Session helpers: a local session for tests and bench, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "alignlake") -> SparkSession:
    """A single-JVM session for tests and benchmarks. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by the session's ``spark.checkpoint.dir``.

    A local session that has not set it gets a fresh temporary folder; a cluster session that has
    not set it is an error, because a machine-local folder would not survive an executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    active = context.getCheckpointDir()
    if active:
        return active
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="alignlake-")
    context.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call will use."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The table stored below the shared folder and read back.

    For costly tables that later steps scan several times: positions, gates and splits each need more
    than one pass, and a stored table also cuts the lineage that a lost executor would replay.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
