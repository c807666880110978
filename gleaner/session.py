"""Spark session helpers.

Cluster jobs take their settings from the submitting environment; these
helpers only fill in what is unset, so a test or a laptop run gets sane
defaults while a cluster keeps its own.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Defaults applied only when the key is not already set on the session.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches for mapInPandas / pandas_udf passes; small enough that a
    # batch of long documents stays well inside a Python worker's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def get_spark(master: str | None = None, app: str = "gleaner",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a local one if none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        _apply_defaults(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("GLEANER_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _apply_defaults(spark)
    return spark


def _apply_defaults(spark: SparkSession) -> None:
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    checkpoint_dir(spark)


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem folder and
    is used as is. Only when it is unset (tests, local runs) do we create a
    private one under the system temp folder.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="gleaner-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df, partitions: int | None = None):
    """Round-robin a small fixture table over the task slots.

    For fixtures only: a one-file table is one split, and the CPU-heavy pass
    after it would run on one core. Operators never call this; a large scan
    has splits enough.
    """
    return df if df.isStreaming else df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)
