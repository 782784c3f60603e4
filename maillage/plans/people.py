"""Persons with their status, and mediators per employer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage import model
from maillage.operators.filters import false_or_null
from maillage.operators.ordering import top_k

# Sources of an employment link.
AIDANTS_CONNECT = "aidants-connect"
COUNSELLOR = "idposte"
MEDIATOR_SOURCES = ("idposte", "coop")


def personne_enrichie(personne: DataFrame, emploi: DataFrame) -> DataFrame:
    """Persons with type, status flags and current employer.

    All five facts about a person come from one aggregate over the active employment
    links, so the links are shuffled once, already combined per person.
    """
    source = F.col("source")
    status = (
        emploi.where("est_active")
        .groupBy(F.col("personne_id").alias("_personne"))
        .agg(
            F.bool_or(source == AIDANTS_CONNECT).alias("_ac"),
            F.bool_or(source.isin(*MEDIATOR_SOURCES)).alias("_med"),
            F.bool_or(source == COUNSELLOR).alias("_cn"),
            F.min("structure_administrative_id").alias("structure_employeuse_id"),
        )
    )
    joined = personne.join(status, F.col("id") == F.col("_personne"), "left")
    ac, med, cn = (F.coalesce(c, F.lit(False)) for c in ("_ac", "_med", "_cn"))
    other = false_or_null(F.col("is_mediateur"))
    mediator, coordinator = (F.coalesce(c, F.lit(False)) for c in ("is_mediateur", "is_coordinateur"))
    in_post, helper_in_post = mediator & med, other & ac
    dated = {"updated_at_ac", "updated_at_coop", "updated_at_idposte", "is_visible", "is_referent_ac"}
    return joined.select(
        *[c for c in personne.columns if c not in dated],
        F.when(other, "aidant_numerique").otherwise("mediateur").alias("type_accompagnateur"),
        ac.alias("labellisation_aidant_connect"),
        in_post.alias("est_actuellement_mediateur_en_poste"),
        helper_in_post.alias("est_actuellement_aidant_numerique_en_poste"),
        cn.alias("est_actuellement_conseiller_numerique"),
        (coordinator & (in_post | helper_in_post)).alias("est_actuellement_coordo_actif"),
        "structure_employeuse_id",
    )


def mediateurs_par_structure(enriched: DataFrame, structure: DataFrame, k: int = model.TOP_K) -> DataFrame:
    """Mediators in post per employer name, largest first.

    Persons are counted per employer before names are joined, so an employer with very
    many persons reaches the join as one row.
    """
    per_employer = (
        enriched.where("est_actuellement_mediateur_en_poste and structure_employeuse_id is not null")
        .groupBy("structure_employeuse_id")
        .agg(F.count("*").alias("nb"))
    )
    named = per_employer.join(
        structure.select("id", "denomination_sirene"), F.col("structure_employeuse_id") == F.col("id")
    )
    counted = named.groupBy("denomination_sirene").agg(F.sum("nb").alias("nb_mediateurs"))
    return top_k(counted, "nb_mediateurs", "denomination_sirene", k)


def structures_par_departement(structure: DataFrame, k: int = model.TOP_K) -> DataFrame:
    counted = structure.groupBy("departement_code").agg(F.count("*").alias("nb_structures"))
    return top_k(counted, "nb_structures", "departement_code", k)


def coordination_active(coordination: DataFrame) -> DataFrame:
    """Mediators per coordinator, closed ties left out."""
    return (
        coordination.where("suppression is null")
        .groupBy("coordinateur_id")
        .agg(F.count_distinct("mediateur_id").alias("nb_mediateurs"))
    )


def formations_par_parcours(formation: DataFrame) -> DataFrame:
    return formation.groupBy("label", "parcours").agg(
        F.count("*").alias("nb_formations"), F.count_distinct("personne_id").alias("nb_personnes")
    )
