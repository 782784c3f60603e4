"""Merge absorbed rows into the survivor: persons and structures.

A merge works on a table of (id, root_id) rows, see ``components.resolve_merge_pairs``,
and treats all groups in one job. Where a survivor absorbs several rows they count in
the order of their ids, as if merged one after the other. Every gap is filled by an
aggregate that combines on the map side, so a survivor with very many absorbed rows
is no hot spot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.functions import array_union_clean, empty_json_to_null, greatest_floor
from maillage.operators.components import drop_losers, remap_ids, remap_parent
from maillage.operators.joins import null_safe_join
from maillage.operators.links import merge_links
from maillage.session import cut

# Columns a merge fills on the survivor.
PERSON_GAPS = (
    "aidant_connect_id", "cn_pg_id", "conseiller_numerique_id", "nb_accompagnements_ac",
    "profession_ac", "is_mediateur", "coop_id",
)
STRUCTURE_IDS = ("structure_coop_id", "structure_ac_id", "structure_cartographie_nationale_id")
STRUCTURE_GAPS = (
    "denomination_sirene", "siret", "rna", "adresse_id", "etat_administratif", "code_activite_principale",
    "categorie_juridique", "publique", "visible_pour_cartographie_nationale", "nb_mandats_ac", "contact",
    "presentation_resume", "presentation_detail", "horaires", "prise_rdv", "structure_parente", "services",
    "publics_specifiquement_adresses", "prise_en_charge_specifique", "autres_formations_labels", "itinerance",
    "modalites_acces", "modalites_accompagnement", "emplois", "mediateurs_en_activite",
)
STRUCTURE_UNIONS = ("typologies", "frais_a_charge", "dispositif_programmes_nationaux", "formations_labels")
PERSON_REFERENCES = {
    "personne_affectations": "personne_id",
    "personne_affectations_emploi": "personne_id",
    "personne_affectations_lieu": "personne_id",
    "activites_coop": "personne_id",
    "contrat": "personne_id",
    "formation": "personne_id",
    "poste": "personne_id",
}
STRUCTURE_REFERENCES = {"poste": "structure_id", "activites_coop": "structure_id", "utilisateur": "structure_id", "membre": "structure_id"}


def absorbed(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """The absorbed rows with the id of their survivor."""
    return df.join(mapping.select("id", "root_id"), "id")


def _first_filled(column: str, usable: Column | None = None) -> Column:
    value = F.col(column) if usable is None else usable
    return F.min_by(value, F.when(value.isNotNull(), F.col("id")))


def _last_filled(column: str) -> Column:
    return F.max_by(F.col(column), F.when(F.col(column).isNotNull(), F.col("id")))


def _write_back(df: DataFrame, per_root: DataFrame, new: Mapping[str, Column], mapping: DataFrame) -> DataFrame:
    """Replace columns of the survivors and remove the absorbed rows."""
    kept = drop_losers(df, mapping)
    joined = kept.join(per_root, kept["id"] == per_root["root_id"], "left")
    return joined.select(
        *[F.when(F.col("root_id").isNotNull(), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in df.columns]
    )


def merge_personne_fields(personne: DataFrame, mapping: DataFrame) -> DataFrame:
    """The survivor's own value wins; its gaps are filled from the absorbed persons.

    A contact without keys counts as a gap. If no contact has keys, the last absorbed
    person's contact is what remains.
    """
    gaps = [c for c in PERSON_GAPS if c in personne.columns]
    aggs = [_first_filled(c).alias(f"_l_{c}") for c in gaps]
    new = {c: F.coalesce(c, f"_l_{c}") for c in gaps}
    if "contact" in personne.columns:
        aggs += [
            _first_filled("contact", empty_json_to_null(F.col("contact"))).alias("_l_contact"),
            F.max_by("contact", "id").alias("_last_contact"),
        ]
        new["contact"] = F.coalesce(empty_json_to_null(F.col("contact")), "_l_contact", "_last_contact")
    per_root = absorbed(personne, mapping).groupBy("root_id").agg(*aggs)
    return _write_back(personne, per_root, new, mapping)


def merge_personne_links(links: DataFrame, mapping: DataFrame) -> DataFrame:
    """Move links to the survivor, without those that repeat one it has already.

    Links repeat on (structure, type, close date), open dates being equal and absent
    structures never equal. Among absorbed persons the smallest id keeps the link.
    """
    roots = mapping.select(F.col("id").alias("_id"), F.col("root_id").alias("_root"))
    placed = links.join(roots, F.col("personne_id") == F.col("_id"), "left").withColumn(
        "_person", F.coalesce("_root", "personne_id")
    )
    keys = ["_person", "structure_id", "type", "suppression"]
    survivors = mapping.select(F.col("root_id").alias("_person")).distinct()
    # Only links of a survivor can repeat. One row per key, combined on the map side, tells
    # whom a repeat gives way to: the survivor's own link, else the smallest absorbed id.
    owners = (
        placed.where("structure_id is not null")
        .join(survivors, "_person", "left_semi")
        .groupBy(*keys)
        .agg(F.bool_or(F.col("_root").isNull()).alias("_own"), F.min(F.when(F.col("_root").isNotNull(), F.col("personne_id"))).alias("_first"))
    )
    joined = null_safe_join(placed, owners, keys, "left")
    repeated = F.col("_root").isNotNull() & F.col("_own").isNotNull() & (
        F.col("_own") | (F.col("personne_id") != F.col("_first"))
    )
    return joined.where(~repeated).select(
        *[F.col("_person").alias(c) if c == "personne_id" else F.col(c) for c in links.columns]
    )


def merge_coordination(coordination: DataFrame, merged_personne: DataFrame, mapping: DataFrame) -> DataFrame:
    """Re-point both ends; a re-pointed end takes the survivor's external id."""
    survivors = mapping.join(
        merged_personne.select(F.col("id").alias("root_id"), F.col("coop_id").alias("_coop")), "root_id", "left"
    ).select(F.col("id").alias("_id"), F.col("root_id").alias("_root"), "_coop")
    out = coordination
    for end, coop in (("mediateur_id", "mediateur_coop_id"), ("coordinateur_id", "coordinateur_coop_id")):
        joined = out.join(survivors, F.col(end) == F.col("_id"), "left")
        moved = F.col("_id").isNotNull()
        new = {end: F.coalesce("_root", end), coop: F.when(moved, F.col("_coop")).otherwise(F.col(coop))}
        out = joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in coordination.columns])
    return out


def merge_persons(tables: Mapping[str, DataFrame], mapping: DataFrame) -> dict[str, DataFrame]:
    """All tables after the merge: fields, links, references, coordination."""
    out = dict(tables)
    out["personne"] = merge_personne_fields(tables["personne"], mapping)
    for name, column in PERSON_REFERENCES.items():
        if name in tables:
            if name == "personne_affectations" and "suppression" in tables[name].columns:
                out[name] = merge_personne_links(tables[name], mapping)
            else:
                out[name] = remap_ids(tables[name], column, mapping)
    if "coordination_mediation" in tables:
        out["coordination_mediation"] = merge_coordination(tables["coordination_mediation"], out["personne"], mapping)
    return out


def _id_parts(structure: DataFrame) -> tuple[list[Column], dict[str, Column]]:
    """Aggregates of the absorbed structures, and the survivor's new values: what an absorbed one has replaces them."""
    ids = [c for c in STRUCTURE_IDS if c in structure.columns]
    return [_last_filled(c).alias(f"_l_{c}") for c in ids], {c: F.coalesce(f"_l_{c}", c) for c in ids}


def _field_parts(structure: DataFrame) -> tuple[list[Column], dict[str, Column]]:
    """The same for single fields: the survivor's own value first."""
    gaps = [c for c in STRUCTURE_GAPS if c in structure.columns]
    aggs, new = [_first_filled(c).alias(f"_l_{c}") for c in gaps], {c: F.coalesce(c, f"_l_{c}") for c in gaps}
    if "source" in structure.columns:
        not_blank = F.nullif(F.col("source"), F.lit(""))
        aggs += [_first_filled("source", not_blank).alias("_l_source"), F.max_by("source", "id").alias("_last_source")]
        new["source"] = F.coalesce(not_blank, "_l_source", "_last_source")
    if "last_sirene_enrich_at" in structure.columns:
        aggs.append(F.max("last_sirene_enrich_at").alias("_l_sirene"))
        new["last_sirene_enrich_at"] = greatest_floor(F.col("last_sirene_enrich_at"), F.col("_l_sirene"))
    return aggs, new


def _list_parts(lists: Sequence[str]) -> tuple[list[Column], dict[str, Column]]:
    """The same for list fields: the only absorbed list as it is, or the cleaned union of several, joined to the survivor's."""
    aggs, new = [], {}
    for c in lists:
        aggs += [F.count(c).alias(f"_n_{c}"), _first_filled(c).alias(f"_one_{c}")]
        many = F.coalesce(f"_many_{c}", F.array().cast("array<string>"))
        absorbed_list = F.when(F.col(f"_n_{c}") == 1, F.col(f"_one_{c}")).when(F.col(f"_n_{c}") > 1, many)
        new[c] = array_union_clean(F.col(c), absorbed_list)
    return aggs, new


def _list_elements(rows: DataFrame, lists: Sequence[str]) -> DataFrame:
    """Per survivor and list field, the distinct elements of the absorbed lists: all fields in one aggregate.

    Elements are made distinct before they are gathered, so what is gathered is the
    vocabulary of a field and not the number of absorbed rows.
    """
    named = F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("list")) for c in lists]))
    elements = rows.select("root_id", named).select("root_id", "field", F.explode("list").alias("e")).where("e is not null and e <> ''")
    return elements.distinct().groupBy("root_id").agg(
        *[F.collect_list(F.when(F.col("field") == c, F.col("e"))).alias(f"_many_{c}") for c in lists]
    )


def _merge_structure(structure: DataFrame, mapping: DataFrame, parts: Sequence[tuple], lists: Sequence[str] = ()) -> DataFrame:
    rows = absorbed(structure, mapping)
    per_root = rows.groupBy("root_id").agg(F.count("*").alias("_n_absorbed"), *[a for aggs, _ in parts for a in aggs])
    if lists:
        per_root = per_root.join(_list_elements(rows, lists), "root_id", "left")
    return _write_back(structure, per_root, {c: v for _, new in parts for c, v in new.items()}, mapping)


def merge_structure_ids(structure: DataFrame, mapping: DataFrame) -> DataFrame:
    """External ids alone: what the absorbed structure has replaces the survivor's value."""
    return _merge_structure(structure, mapping, [_id_parts(structure)])


def merge_structure_fields(structure: DataFrame, mapping: DataFrame, unions: Sequence[str] = STRUCTURE_UNIONS) -> DataFrame:
    """Fields alone: survivor first for single fields, cleaned union for the four list fields."""
    lists = [c for c in unions if c in structure.columns]
    return _merge_structure(structure, mapping, [_field_parts(structure), _list_parts(lists)], lists)


def merge_structure_rows(structure: DataFrame, mapping: DataFrame, unions: Sequence[str] = STRUCTURE_UNIONS) -> DataFrame:
    """External ids, single fields and lists at once, then the absorbed rows go.

    The two functions above each remove the absorbed rows, so neither can follow the other.
    """
    lists = [c for c in unions if c in structure.columns]
    return _merge_structure(structure, mapping, [_id_parts(structure), _field_parts(structure), _list_parts(lists)], lists)


def merge_structures(tables: Mapping[str, DataFrame], mapping: DataFrame, now: Column | None = None) -> dict[str, DataFrame]:
    """All tables after the merge: structures, links to persons, other references, children.

    Links are matched by the absorbed structure's external id as it was before the merge.
    Children of the survivor's replaced external id follow it as well as those of the absorbed one's.
    """
    before = tables["structure"]
    after = merge_structure_rows(before, mapping)
    out = dict(tables)
    for name, column in STRUCTURE_REFERENCES.items():
        if name in tables:
            out[name] = remap_ids(tables[name], column, mapping)
    if "structure_coop_id" in before.columns:
        codes = before.select("id", F.col("structure_coop_id").alias("_old"))
        if "personne_affectations" in tables:
            pairs = mapping.join(codes, "id").select(F.col("root_id").alias("winner_id"), F.col("id").alias("loser_id"), F.col("_old").alias("loser_coop_id"))
            out["personne_affectations"] = merge_links(tables["personne_affectations"], cut(pairs), now)
        if "structure_parente" in before.columns:
            roots = mapping.select("id", "root_id").unionByName(mapping.select(F.col("root_id").alias("id"), "root_id").distinct())
            new = after.select(F.col("id").alias("root_id"), F.col("structure_coop_id").alias("_new"))
            # External ids are unique; should one be held twice, its smallest new value counts.
            moved = (
                roots.join(codes, "id").join(new, "root_id").where("_old <> _new")
                .groupBy(F.col("_old").alias("id")).agg(F.min("_new").alias("root_id"))
            )
            after = remap_parent(after, "structure_parente", moved)
    out["structure"] = after
    return out
