"""Session settings and durable stage boundaries."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Only read when the session starts. Capturing the call site of every column expression costs several calls into the
# JVM each, and wide matrices are built from thousands of expressions.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def builder(app: str, master: str | None = None, **settings: str) -> SparkSession.Builder:
    """A session builder with all settings; ``settings`` use ``__`` for dots. Without ``master`` the launcher decides."""
    chosen = SparkSession.builder.appName(app)
    if master:
        chosen = chosen.master(master)
    extra = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SETTINGS, **START_SETTINGS, **extra}.items():
        chosen = chosen.config(name, value)
    return chosen


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator assumes (UTC dates, adaptive plans)."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package. On a cluster it is installed or sent with ``--py-files``."""
    home, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (home, known)))


def stage_folder(spark: SparkSession) -> str:
    """Shared folder for stage tables: the cluster's ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master with nothing configured.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="ledgerlens-")


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once through a reliable checkpoint and read it back.

    Used where several operators share an expensive input. The result lives in the shared
    folder, so losing executors costs a re-read and not a recomputation.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(stage_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    For inputs that many operators scan: unlike a checkpoint, later scans read only the columns they need.
    """
    path = f"{stage_folder(df.sparkSession)}/ledgerlens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
