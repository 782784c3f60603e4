"""Small column helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maillage.session import shared_folder

ROW_GROUP = 32 << 20  # bytes; rows here may hold whole texts, and a writer keeps a row group in memory
SPACES = r"[\x20\x09-\x0D]+"


# Rows hold whole texts: Arrow batches are bounded by bytes, and by rows where the session knows no bytes.
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limits on Arrow batches where they are above ARROW_LIMITS."""
    for key, limit in ARROW_LIMITS.items():
        now = spark.conf.get(key, None)
        if now is not None and not 0 < int(now.rstrip("bB")) <= int(limit):
            spark.conf.set(key, limit)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_hash(doc_id: Column) -> Column:
    """crc32 of an id as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows whose labels are not learned; false for a null id."""
    return F.coalesce(id_hash(doc_id) % modulus == remainder, F.lit(False))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Maximal runs of characters other than 0x20 and 0x09-0x0D; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: lineage is cut, columns stay prunable."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
