"""Territories: flattening, comparison, fragility, zones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coll_terr(commune: DataFrame, departement: DataFrame, region: DataFrame) -> DataFrame:
    """Communes with the codes and names of their department and region."""
    d = departement.select(
        F.col("id").alias("_d"), "region_id", F.col("code").alias("departement_code"), F.col("nom").alias("departement_nom")
    )
    r = region.select(F.col("id").alias("_r"), F.col("code").alias("region_code"), F.col("nom").alias("region_nom"))
    return (
        commune.join(d, F.col("departement_id") == F.col("_d"), "left")
        .join(r, F.col("region_id") == F.col("_r"), "left")
        .select(
            "region_code", "region_nom", "departement_code", "departement_nom",
            F.col("code_insee").alias("commune_code"), F.col("nom").alias("commune_nom"),
        )
    )


def fragilite_territoire(
    territory: DataFrame, ifn: DataFrame, code: str, by: Sequence[str] = (), population: str = "population"
) -> DataFrame:
    """Mean fragility score weighted by population, over territories that have a score."""
    score = F.col("score").cast("decimal(10,4)")
    joined = territory.join(ifn.select(F.col(code).alias("_code"), score.alias("score")), F.col(code) == F.col("_code"))
    return joined.groupBy(*by).agg(
        F.count("*").alias("nb_territoires"),
        F.sum(population).alias("population"),
        (
            F.sum(F.col("score") * F.col(population)).cast("double") / F.nullif(F.sum(F.when(F.col("score").isNotNull(), F.col(population))), F.lit(0))
        ).alias("score_moyen"),
    )


def structures_en_zone(sites: DataFrame, zonage: DataFrame, kinds: Sequence[str] = ("FRR", "QPV")) -> DataFrame:
    """Sites and communes inside a zone of each kind, and their share of all.

    A commune with several zones of one kind counts once: the zones are made distinct
    before they meet the sites.
    """
    zones = zonage.groupBy("code_insee").agg(*[F.bool_or(F.col("type") == k).alias(k) for k in kinds])
    per_commune = sites.groupBy("code_insee").agg(F.count("*").alias("_n"))
    joined = per_commune.join(zones, "code_insee", "left")
    measures = []
    for k in kinds:
        measures += [F.sum(F.when(F.col(k), F.col("_n"))).alias(f"s_{k}"), F.count_if(k).alias(f"c_{k}")]
    totals = joined.agg(F.sum("_n").alias("s"), F.count("*").alias("c"), *measures)
    rows = F.array(*[
        F.struct(
            F.lit(k).alias("type"),
            F.coalesce(f"s_{k}", F.lit(0).cast("bigint")).alias("nb_sites"),
            F.col(f"c_{k}").alias("nb_communes"),
            (F.coalesce(f"s_{k}", F.lit(0).cast("bigint")) / F.col("s")).alias("part_sites"),
            (F.col(f"c_{k}") / F.col("c")).alias("part_communes"),
        )
        for k in kinds
    ])
    return totals.select(F.inline(rows))


def comparaison_territoriale(df: DataFrame, region: str, departement: str, sums: Mapping[str, Column]) -> DataFrame:
    """Each department beside its region and the nation.

    The rows are aggregated once per department; region and nation are sums of those.
    """
    local = df.groupBy(region, departement).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    by_region = local.groupBy(F.col(region).alias("_region")).agg(*[F.sum(n).alias(f"{n}_region") for n in sums])
    nation = local.agg(F.struct(*[F.sum(n).alias(f"{n}_nation") for n in sums])).scalar()
    joined = local.join(by_region, F.col(region).eqNullSafe(F.col("_region")), "left").drop("_region")
    return joined.withColumn("_nation", nation).select(*joined.columns, "_nation.*")
