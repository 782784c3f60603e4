"""Loading by natural key, and the marks a change leaves."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maillage.operators.ordering import first_row_per_key


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str, now: Column | None = None,
    stamp: str = "updated_at",
) -> DataFrame:
    """Update rows of ``target`` by key and insert new keys; the newest update of a key wins.

    ``order_col`` is a column of ``updates`` that orders repeats of one key; repeats equal
    in it are settled by their content (the smallest as JSON), so a rerun gives the same
    rows. A key with a
    NULL part equals nothing: such rows of either side pass by the join, where they would
    all meet in one task, and such updates are inserted. With ``now``, ``stamp`` is set
    on the rows an update really changed.
    """
    whole_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    columns = target.columns
    values = [c for c in columns if c not in keys]
    content = F.to_json(F.struct(*values), {"ignoreNullFields": "false"}) if values else F.lit("")
    newest = first_row_per_key(updates.where(whole_key), keys, [F.col(order_col).desc_nulls_last(), content]).select(*columns)
    new = newest.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in values], F.lit(True).alias("_new"))
    old = target.where(whole_key).withColumn("_old", F.lit(True))
    joined = old.join(new, list(keys), "full_outer")
    compared = [c for c in values if c != stamp]
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in compared], F.lit(False))
    out = {c: F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)) for c in values}
    if now is not None and stamp in values:
        updated = F.coalesce(F.col("_new") & F.col("_old"), F.lit(False))
        out[stamp] = F.when(updated, F.when(changed, now).otherwise(F.col(stamp))).otherwise(out[stamp])
    merged = joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in columns])
    return merged.unionByName(target.where(~whole_key)).unionByName(updates.where(~whole_key).select(*columns))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class DuplicateKeys(ValueError):
    """Rows of the target share a key, so an update would change several of them."""


@dataclass(frozen=True)
class StoredTarget:
    """A table in files dealt out by the hash of its key, so that an update rewrites only the parts it touches.

    ``buckets`` is fixed when the table is written. Choose it so that a part is what one task may rewrite: an update
    of few keys costs a few parts, one of many keys the table. Each part is replaced as a whole when the job commits
    (dynamic partition overwrite); readers of other parts are not concerned.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 256

    def write(self, rows: DataFrame) -> None:
        self._put(rows, "errorifexists")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("_bucket")

    def duplicated_keys(self, rows: DataFrame) -> DataFrame:
        """Whole keys that several rows hold, with their number."""
        return rows.select(*self.keys).dropna().groupBy(*self.keys).agg(F.count("*").alias("nb")).where("nb > 1")

    def upsert(self, updates: DataFrame, order_col: str, now: Column | None = None, stamp: str = "updated_at") -> list[int]:
        """Apply ``upsert`` to the stored rows; the parts that were rewritten.

        Keys that the touched parts hold twice are an error that names some of them; nothing is written then.
        Updates are read twice. They may not change the table's columns.
        """
        spark = updates.sparkSession
        mark = _bucket(self.keys, self.buckets)
        touched = sorted(r["b"] for r in updates.select(mark.alias("b")).distinct().collect())  # a number per part
        if not touched:
            return []
        stored = spark.read.parquet(self.path)
        rows = stored.where(F.col("_bucket").isin(touched)).drop("_bucket")
        twice = self.duplicated_keys(rows).limit(20).collect()
        if twice:
            raise DuplicateKeys(", ".join(str(tuple(r)) for r in twice))
        self._put(upsert(rows, updates, self.keys, order_col, now, stamp), "overwrite")
        spark.catalog.refreshByPath(self.path)
        return touched

    def _put(self, rows: DataFrame, mode: str) -> None:
        parts = rows.withColumn("_bucket", _bucket(self.keys, self.buckets)).repartition("_bucket")
        parts.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.path)


DIGESTED = 1024  # buckets of keys that are compared as a whole


def changed_buckets(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> list[int]:
    """Buckets of keys whose rows differ between two snapshots.

    A bucket's digest is the number of its rows and the sums of two hashes of each, in whole numbers, so it depends
    neither on the order of rows nor on how they are stored. The driver gets a number per bucket that differs.
    """
    def digests(df: DataFrame, sign: int) -> DataFrame:
        hashes = [F.xxhash64(F.lit(seed), key, *columns).cast("decimal(20,0)") for seed in (1, 2)]
        return df.select(_bucket([key], DIGESTED).alias("bucket"), F.lit(sign).alias("n"), *[(h * sign).cast("decimal(20,0)").alias(f"h{i}") for i, h in enumerate(hashes)])

    both = digests(before, -1).unionAll(digests(after, 1)).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "h0", "h1")])
    return sorted(r["bucket"] for r in both.where("n <> 0 or h0 <> 0 or h1 <> 0").select("bucket").collect())


def stamp_updated_at(before: DataFrame, after: DataFrame, key: str, now: Column, stamp: str = "updated_at") -> DataFrame:
    """Set the stamp on the rows of ``after`` that differ from ``before``.

    Digests of buckets of keys are compared first, in one aggregate over both; only rows of buckets that differ are
    joined. Tables that are the same are not joined at all. A NULL key is no known row.
    """
    compared = [c for c in after.columns if c not in (key, stamp)]
    buckets = changed_buckets(before, after, key, compared)
    if not buckets:
        return after
    differs = _bucket([key], DIGESTED).isin(buckets)
    old = before.where(differs).select(key, *[F.col(c).alias(f"_o_{c}") for c in compared], F.lit(True).alias("_old"))
    joined = after.where(differs).join(old, key, "left")
    changed = F.coalesce(F.col("_old"), F.lit(False)) & reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in compared], F.lit(False)
    )
    stamped = joined.select(*[F.when(changed, now).otherwise(F.col(c)).alias(c) if c == stamp else F.col(c) for c in after.columns])
    return stamped if len(buckets) == DIGESTED else stamped.unionByName(after.where(~differs))


def stamp_edited_by(df: DataFrame, source: str, where: Column | None = None) -> DataFrame:
    """Name the writing source on the rows it wrote."""
    mark = F.lit(source) if where is None else F.when(where, F.lit(source)).otherwise(F.col("edited_by"))
    return df.withColumn("edited_by", mark)


def append_deleted_by(df: DataFrame, source: str, where: Column) -> DataFrame:
    """Add the source to the list of those that marked the row as deleted, once."""
    listed = F.array_union(F.coalesce("deleted_by", F.array().cast("array<string>")), F.array(F.lit(source)))
    return df.withColumn("deleted_by", F.when(where, listed).otherwise(F.col("deleted_by")))
