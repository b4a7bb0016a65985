"""Session set-up and the few helpers that depend on the cluster's settings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ceiling for a side that is broadcast on purpose. Dimension rows here are a few
# numbers and short strings, so this stays near 100 MB per executor.
BROADCAST_MAX_ROWS = 1_000_000


def get_session(app_name: str = "climagrid", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC with adaptive execution, skew-join splitting and dynamic overwrite."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        # Checkpoints go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Recording the Python line of every expression costs more than the expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/climagrid-{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably in the shared folder and continue from the stored copy."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def is_small(stored: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether a side has at most ``max_rows`` rows, by counting them.

    Meant for tables, ``cut_lineage`` results and generated ranges, where the count
    is cheap. A larger side is joined without a hint: as a shuffled join that
    adaptive execution may still re-plan or split.
    """
    return stored.count() <= max_rows


def broadcast_if_small(stored: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Mark a side for broadcast when its counted size allows it."""
    return F.broadcast(stored) if is_small(stored, max_rows) else stored
