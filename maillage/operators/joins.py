"""Joins that carry a rule of their own. Plain equi-joins are left to ``DataFrame.join``.

Throughout, the side that may hold a hot key is on the left and the right side has
one row per key, so adaptive execution can split the hot key over many tasks
(see ``join_unique``). No side is broadcast by hint: Spark broadcasts what it has measured to be small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.session import cut


def _stand_in(kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return F.lit("")
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, T.BinaryType):
        return F.lit("").cast(kind)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    raise TypeError(f"no key type: {kind.simpleString()}")


def join_unique(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, nulls_equal: bool = False
) -> DataFrame:
    """Join to a side that was aggregated to one row per key, with hot keys on the left.

    The join runs on columns derived from the keys: the value without NULL, and whether
    it is absent. This has two uses. NULL can equal NULL under plain equality. And
    Spark shuffles the aggregated side once more instead of joining it where it was
    aggregated; adaptive execution splits a hot key only between two plain shuffles, so
    without that small extra shuffle a hot key on the left would stay in one task.
    """
    columns = {}
    for k in keys:
        columns[f"_v_{k}"] = F.coalesce(F.col(k), _stand_in(left.schema[k].dataType))
        columns[f"_a_{k}"] = F.col(k).isNull()
    other = right if nulls_equal else right.dropna(subset=list(keys))
    return left.withColumns(columns).join(other.withColumns(columns).drop(*keys), list(columns), how).drop(*columns)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL; the key columns of ``left`` are kept."""
    return join_unique(left, right, keys, how, nulls_equal=True)


def flag_matches(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Boolean column: does a row with the same (null-safe) keys exist in ``keys_df``."""
    found = keys_df.select(*keys).distinct().withColumn(flag, F.lit(True))
    return null_safe_join(df, found, keys, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def delete_using(df: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a match in ``doomed``; a NULL key never matches."""
    return join_unique(df, doomed.select(*keys).distinct(), keys, "left_anti")


def update_from(df: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwrite the columns of ``changes`` (one row per key) in the matching rows, NULL values included."""
    values = [c for c in changes.columns if c not in keys]
    new = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_hit"))
    joined = df.join(new, list(keys), "left")
    return joined.select(
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns]
    )


def join_bridge(left: DataFrame, bridge: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """N:N join through a bridge table that has columns ``left_key`` and ``right_key``."""
    return left.join(bridge, left_key).join(right, right_key)


def join_lookup(df: DataFrame, lookup: DataFrame, code: str, lookup_code: str, label: str, alias: str) -> DataFrame:
    """Code -> label; an unknown code keeps its row with a NULL label."""
    names = lookup.select(F.col(lookup_code).alias("_code"), F.col(label).alias(alias))
    return df.join(names, F.col(code) == F.col("_code"), "left").drop("_code")


def join_ci(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Join on text without regard to case."""
    return left.join(right, F.lower(left[left_key]) == F.lower(right[right_key]), how)


def follow_insee_history(history: DataFrame) -> DataFrame:
    """(code_insee_ancien, code_insee_nouveau, done): every code with the codes its changes lead to.

    Each round doubles the length of the paths, so a chain of n changes takes log2(n) rounds. Rows that are not
    ``done`` are left only where paths became longer than there are codes, which takes a circle. A change to the
    same code and a NULL code are no change.
    """
    step = (
        history.where(F.col("code_insee_ancien") != F.col("code_insee_nouveau"))
        .select("code_insee_ancien", "code_insee_nouveau")
        .distinct()
    )
    changed = step.select(F.col("code_insee_ancien").alias("code_insee_nouveau"), F.lit(True).alias("_again")).distinct()
    reach = join_unique(step, changed, ["code_insee_nouveau"], "left")
    reach = cut(reach.select("code_insee_ancien", "code_insee_nouveau", F.col("_again").isNull().alias("done")))
    codes, length = changed.count(), 1
    while length <= codes and not reach.where("not done").isEmpty():
        rest = reach.select(F.col("code_insee_ancien").alias("_via"), F.col("code_insee_nouveau").alias("_to"), F.col("done").alias("_done"))
        longer = reach.where("not done").join(rest, F.col("code_insee_nouveau") == F.col("_via"))
        longer = longer.select("code_insee_ancien", F.col("_to").alias("code_insee_nouveau"), F.col("_done").alias("done"))
        reach = cut(reach.where("done").unionByName(longer).distinct())
        length *= 2
    return reach


def resolve_insee_history(history: DataFrame) -> DataFrame:
    """Old -> current code, over any number of successive changes.

    A code that was split has several current codes; ``nb_codes`` reports how many.
    The history alone is chained, so the fact table is joined once. A code that leads
    into a circle and nowhere else has no current code; ``insee_history_circles`` lists it.
    """
    current = follow_insee_history(history).where("done").drop("done")
    width = current.groupBy("code_insee_ancien").agg(F.count("*").alias("nb_codes"))
    return join_unique(current, width, ["code_insee_ancien"], "inner")


def insee_history_circles(history: DataFrame) -> DataFrame:
    """Codes whose changes lead into a circle."""
    return follow_insee_history(history).where("not done").select("code_insee_ancien").distinct()


def join_insee_history(df: DataFrame, history: DataFrame, code: str = "code_insee") -> DataFrame:
    """Add the current code and the number of codes the old one was split into (1 if unchanged or without a current code)."""
    current = resolve_insee_history(history).withColumnRenamed("code_insee_ancien", code)
    return join_unique(df, current, [code], "left").select(
        *df.columns,
        F.coalesce("code_insee_nouveau", code).alias("code_insee_actuel"),
        F.coalesce("nb_codes", F.lit(1)).alias("nb_codes_actuels"),
    )


def join_legacy_mapping(legacy: DataFrame, entities: DataFrame) -> DataFrame:
    """Legacy row id -> id of the entity that replaced it.

    The entity that names the legacy row wins; a row absorbed by a merge is found by
    its SIRET, where the smallest entity id stands for the SIRET.
    """
    direct = entities.where("old_main_structure_id is not null").select(
        F.col("old_main_structure_id").alias("id"), F.col("id").alias("_direct")
    )
    by_siret = entities.where("siret is not null").groupBy("siret").agg(F.min("id").alias("_by_siret"))
    found = join_unique(legacy.join(direct, "id", "left"), by_siret, ["siret"], "left")
    return found.select(*legacy.columns, F.coalesce("_direct", "_by_siret").alias("structure_administrative_id"))


def existence_flags(df: DataFrame, links: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """One boolean column per condition: does a link of this ``key`` satisfy it.

    All conditions share one aggregate that combines on the map side.
    """
    found = links.groupBy(key).agg(*[F.bool_or(cond).alias(name) for name, cond in flags.items()])
    joined = join_unique(df, found, [key], "left")
    return joined.select(*df.columns, *[F.coalesce(name, F.lit(False)).alias(name) for name in flags])
