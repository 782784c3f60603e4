"""Persisted results that are recomputed in full."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import Row, StructType

POINTER = "version long, folder string, content string, at timestamp"
KEPT = timedelta(days=7)  # for how long readers of an old version may go on


def _pointers(spark: SparkSession, target: str) -> list[Row]:
    """One row per version there is, and one with the negative number per version that was emptied; in order."""
    try:
        rows = spark.read.schema(POINTER).json(f"{target}/_pointer")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(rows.collect(), key=lambda r: (r["version"], r["folder"]))  # a row per refresh


def _point(spark: SparkSession, target: str, version: int, folder: str, content: str, at: datetime | None = None) -> None:
    # One row is one file, which appears as a whole when the job commits.
    row = (version, folder, content, at or datetime.now(timezone.utc))
    spark.createDataFrame([row], POINTER).coalesce(1).write.mode("append").json(f"{target}/_pointer")


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version that was finished. What is returned goes on reading that version, whatever happens meanwhile."""
    target = path.rstrip("/")
    versions = [p for p in _pointers(spark, target) if p["version"] > 0]
    if not versions:
        raise FileNotFoundError(f"no version of {target}")
    latest = versions[-1]
    return spark.read.schema(StructType.fromJson(json.loads(latest["content"]))).parquet(f"{target}/{latest['folder']}")


def refresh_table(spark: SparkSession, path: str, builder: Callable[[], DataFrame]) -> DataFrame:
    """Recompute a table as a new version, and point readers to it once it is there.

    Each version is a folder of its own and is never changed. The pointer with the highest number decides which one
    counts, and each pointer is a file that appears as a whole; so a reader between any two steps finds the old or the
    new version complete. A job that fails leaves a folder that no pointer names. Of two jobs at the same time both
    versions are kept, and one is current, the same for all readers. The builder may read the table it replaces, with
    ``current_table``.
    """
    target = path.rstrip("/")
    folder = f"version_{uuid.uuid4().hex}"
    built = builder()
    built.write.parquet(f"{target}/{folder}")
    latest = max((p["version"] for p in _pointers(spark, target)), default=0)
    _point(spark, target, max(latest, 0) + 1, folder, built.schema.json())
    return current_table(spark, target)


def expire_versions(spark: SparkSession, path: str, kept: timedelta = KEPT, now: datetime | None = None) -> list[str]:
    """Empty the folders of versions that were replaced more than ``kept`` ago; their names.

    The current version stays, and so do those that a reader may still hold.
    """
    target = path.rstrip("/")
    pointers = _pointers(spark, target)
    gone = {p["folder"] for p in pointers if p["version"] < 0}
    versions = [p for p in pointers if p["version"] > 0]
    moment = now or datetime.now(timezone.utc).replace(tzinfo=None)
    old = [p for p, following in zip(versions, versions[1:]) if p["folder"] not in gone and moment - following["at"] > kept]
    for p in old:
        content = StructType.fromJson(json.loads(p["content"]))
        spark.createDataFrame([], content).write.mode("overwrite").parquet(f"{target}/{p['folder']}")
        _point(spark, target, -p["version"], p["folder"], p["content"])
    return [p["folder"] for p in old]
