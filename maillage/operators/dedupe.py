"""Which rows describe the same address, entity or person."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.operators.components import connected_components
from maillage.operators.joins import join_unique, null_safe_join


def duplicate_mapping(df: DataFrame, key: Mapping[str, Column], id_col: str = "id") -> DataFrame:
    """(id, kept_id) for rows that repeat a key, NULL parts being equal; the smallest id is kept.

    The kept id is an aggregate joined back, not a window, so a key shared by very many
    rows is split over tasks.
    """
    keyed = df.select(F.col(id_col).alias("id"), *[c.alias(k) for k, c in key.items()])
    kept = keyed.groupBy(*key).agg(F.min("id").alias("kept_id"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return null_safe_join(keyed, kept, list(key), "inner").where("id <> kept_id").select("id", "kept_id")


def dedupe_adresse(adresse: DataFrame) -> DataFrame:
    return duplicate_mapping(
        adresse,
        {
            "code_postal": F.col("code_postal"),
            "nom_commune": F.col("nom_commune"),
            "nom_voie": F.col("nom_voie"),
            "numero": F.coalesce(F.col("numero_voie").cast("int"), F.lit(0)),
            "repetition": F.coalesce("repetition", F.lit("")),
        },
    )


def dedupe_structure_siret(structure: DataFrame) -> DataFrame:
    return duplicate_mapping(structure, {c: F.col(c) for c in ("siret", "denomination_antenne")})


def dedupe_personne_ids(personne: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """(id, kept_id) for persons linked, directly or through others, by a shared external id.

    Holders of one external id are all tied to its smallest holder: one edge per
    holder, never all pairs of holders.
    """
    held = personne.select("id", F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in kinds
    ]))).where("value is not null")
    first = held.groupBy("kind", "value").agg(F.min("id").alias("first"))
    edges = join_unique(held, first, ["kind", "value"], "inner").where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    return connected_components(edges).where("node <> root").select(F.col("node").alias("id"), F.col("root").alias("kept_id"))


def split_structure(legacy: DataFrame, site_columns: Sequence[str], entity_columns: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Legacy rows -> (sites, legal entities, bridge).

    Every legacy row becomes one site. Rows of one (siret, denomination_antenne) become
    one entity, which takes the columns of the row with the smallest id. A row without
    both becomes no entity and has no bridge row.
    """
    key = ["siret", "denomination_antenne"]
    sites = legacy.select("id", F.col("id").alias("old_main_structure_id"), *site_columns)
    named = legacy.where("siret is not null or denomination_antenne is not null")
    entities = named.groupBy(*key).agg(
        F.min("id").alias("id"), *[F.min_by(c, "id").alias(c) for c in entity_columns]
    ).withColumn("old_main_structure_id", F.col("id"))
    bridge = null_safe_join(named.select("id", *key), entities.select(F.col("id").alias("_entity"), *key), key, "inner").select(
        F.col("id").alias("lieu_id"), F.col("_entity").alias("structure_administrative_id")
    )
    return sites, entities.select("id", "old_main_structure_id", *key, *entity_columns), bridge


def merge_import_warnings(df: DataFrame, rules: Mapping[str, Column], alias: str = "import_warnings") -> DataFrame:
    """Names of the violated rules as one JSON array; NULL when nothing is violated."""
    hits = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()]))
    return df.withColumn(alias, F.when(F.size(hits) > 0, F.to_json(hits)))
