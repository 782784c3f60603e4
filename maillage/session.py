"""Session set-up, and cutting the lineage of iterative jobs."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the plans rely on. Sizes (executors, memory, shuffle
# partitions) belong to the cluster and are left alone.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where that costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators count on to a session somebody else built."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "maillage", master: str | None = None, **options: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    # Rounds that were cut are removed once nothing refers to them.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can read, named by ``spark.checkpoint.dir``.

    Only a ``local`` master, where driver and executors are one process, may go
    without: it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return _own_folder()


@lru_cache(1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="maillage-")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so a lost executor costs one step, not all."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
