"""Raw sources: land unchanged, read with an explicit schema, clean, give keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def land_raw(df: DataFrame, source: str, table: str, root: str) -> str:
    """Copy a source as it is to ``root/import/{source}__{table}``; returns the path."""
    path = f"{root.rstrip('/')}/import/{source}__{table}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_csv_source(spark: SparkSession, path: str, schema: T.StructType | str, **options: object) -> DataFrame:
    """CSV with a header. A row that does not fit the schema fails the job instead of turning NULL."""
    return spark.read.schema(schema).options(**{"header": True, "mode": "FAILFAST", **options}).csv(path)


def read_json_source(spark: SparkSession, path: str, schema: T.StructType | str, payload: str | None = "attributes") -> DataFrame:
    """Saved API payloads, one JSON object per line; the fields below ``payload`` are lifted up."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if payload is None:
        return df
    return df.select(*[c for c in df.columns if c != payload], f"{payload}.*")


def ingest_clean(df: DataFrame, renames: Mapping[str, str], blanks_to_null: bool = True) -> DataFrame:
    """Rename columns, trim text, and turn blank text into NULL."""
    out = df.withColumnsRenamed(dict(renames))
    text = [f.name for f in out.schema.fields if isinstance(f.dataType, T.StringType)]
    clean = {c: F.nullif(F.trim(c), F.lit("")) if blanks_to_null else F.trim(c) for c in text}
    return out.withColumns(clean) if clean else out


def ingest_surrogate_key(df: DataFrame, source: str, keys: Sequence[str], alias: str = "uuid") -> DataFrame:
    """UUID-shaped key computed from source and natural key: the same row always gets the same key.

    Each part is led by its length, a NULL part is a mark of its own, so different keys never read alike.
    """

    def part(value: Column) -> Column:
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    digest = F.sha2(F.concat_ws("|", *(part(v) for v in (F.lit(source), *(F.col(k).cast("string") for k in keys)))), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return df.withColumn(alias, F.concat_ws("-", *[F.substring(digest, at, n) for at, n in cuts]))
