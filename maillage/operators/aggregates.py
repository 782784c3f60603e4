"""Aggregates that need more than ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_count(df: DataFrame, array: str | Column, by: Sequence[str] = (), alias: str = "element") -> DataFrame:
    """Rows per element of a text array; empty and NULL arrays count nowhere."""
    column = F.col(array) if isinstance(array, str) else array
    return df.select(*by, F.explode(column).alias(alias)).groupBy(*by, alias).agg(F.count("*").alias("nb"))


def sum_json_counts(df: DataFrame, json: str, groups: Sequence[str]) -> DataFrame:
    """Sum the counters of a JSON column: its ``total``, and every counter below ``groups``.

    The text is parsed once; each group then becomes one row that holds its counters.
    """
    schema = "struct<total bigint, " + ", ".join(f"{g} map<string, bigint>" for g in groups) + ">"
    parsed = df.select(F.from_json(json, schema).alias("j"))
    total = F.struct(F.lit("total").alias("groupe"), F.create_map(F.lit("total"), F.col("j.total")).alias("compteurs"))
    others = [F.struct(F.lit(g).alias("groupe"), F.col(f"j.{g}").alias("compteurs")) for g in groups]
    return (
        parsed.select(F.inline(F.array(total, *others)))
        .select("groupe", F.explode("compteurs").alias("cle", "nb"))
        .where("nb is not null")
        .groupBy("groupe", "cle")
        .agg(F.sum("nb").alias("nb"))
    )


def aggregate_only(df: DataFrame, group: Sequence[str], measures: Mapping[str, Column], min_group: int = 1) -> DataFrame:
    """Aggregates only; groups smaller than ``min_group`` are withheld (default: none)."""
    out = df.groupBy(*group).agg(F.count("*").alias("nb"), *[m.alias(n) for n, m in measures.items()])
    return out.where(F.col("nb") >= min_group)


def rollup_territory(df: DataFrame, levels: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Sums at every grain, from the whole country down to the last of ``levels``.

    Rows are first combined at the finest grain, so the rollup multiplies one row per
    territory and not the input.
    """
    finest = df.groupBy(*levels).agg(F.count("*").alias("nb"), *[F.sum(c).alias(n) for n, c in sums.items()])
    return finest.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("niveau"),
        F.sum("nb").alias("nb"),
        *[F.sum(n).alias(n) for n in sums],
    )
