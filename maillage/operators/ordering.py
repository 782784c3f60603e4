"""First row per key, neutralising the others, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maillage.operators.joins import null_safe_join


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``; NULL keys form one group.

    Filtering on rank 1 lets Spark keep one row per key on the map side already
    (WindowGroupLimit), so a hot key ships one row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_by(df: DataFrame, keys: Sequence[str], clocks: Sequence[str], tie: str) -> DataFrame:
    """Row with the newest of several source clocks per key; ``tie`` settles equal clocks."""
    newest = F.greatest(*[F.col(c) for c in clocks]) if len(clocks) > 1 else F.col(clocks[0])
    return first_row_per_key(df, keys, [newest.desc_nulls_last(), F.col(tie).asc()])


def neutralise_rest(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], id_col: str, columns: Sequence[str], where: Column | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Keep the first row per key, set ``columns`` to NULL in the other rows of the key.

    The keeper is found with an aggregate that combines on the map side and is joined
    back, so no group is ever gathered in one task. ``order`` are ascending expressions
    and ``id_col`` settles ties. Rows outside ``where`` pass by the join. With ``now``, ``updated_at`` is set on the rows changed.
    """
    scope = df if where is None else df.where(where)
    keepers = (
        scope.groupBy(*keys)
        .agg(
            F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(id_col).alias("id"))).alias("_first"),
            F.count("*").alias("_n"),
        )
        .where("_n > 1")
        .select(*keys, F.col("_first.id").alias("_kept"))
    )
    joined = null_safe_join(scope, keepers, keys, "left")
    loses = F.col("_kept").isNotNull() & (F.col(id_col) != F.col("_kept"))
    new = {c: F.when(~loses, F.col(c)) for c in columns}
    if now is not None and "updated_at" in df.columns:
        new["updated_at"] = F.when(loses, now).otherwise(F.col("updated_at"))
    out = joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])
    return out if where is None else out.unionByName(df.where(~F.coalesce(where, F.lit(False))))


def top_k(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    """Largest ``k`` rows by ``measure``; ``key`` breaks ties."""
    return df.orderBy(F.col(measure).desc(), F.col(key).asc_nulls_last()).limit(k)
