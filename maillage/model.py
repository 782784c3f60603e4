"""Declared facts of the data model: keys, references, rules, access tiers.

The column types come with the data (Parquet, JDBC or an explicit reader schema).
What the files do not carry is stated here and drives the quality and privacy jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Primary keys. Every table has `id` unless named here.
# --------------------------------------------------------------------------
PRIMARY_KEY_EXCEPTIONS = {
    "min.beneficiaire_subvention": ("demande_de_subvention_id", "membre_id"),
    "min.contact_membre_gouvernance": ("email",),
    "min.departement_enveloppe": ("departement_code", "enveloppe_id"),
    "min.departement": ("code",),
    "min.gouvernance": ("departement_code",),
    "min.porteur_action": ("action_id", "membre_id"),
    "min.region": ("code",),
}


def primary_key(table: str) -> tuple[str, ...]:
    return PRIMARY_KEY_EXCEPTIONS.get(table, ("id",))


@dataclass(frozen=True)
class Unique:
    """A unique key. ``keys`` are SQL expressions; ``where`` restricts it to a subset."""

    table: str
    keys: tuple[str, ...]
    nulls_equal: bool = False
    where: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str
    on_delete: str = "NO ACTION"


@dataclass(frozen=True)
class Check:
    """A row rule as a SQL predicate. A row fails only when the predicate is false, not NULL."""

    table: str
    name: str
    predicate: str


# --------------------------------------------------------------------------
# Unique constraints, then the unique indexes that add a rule of their own.
# --------------------------------------------------------------------------
SENTINEL = "timestamp'1234-01-02 03:04:05+00:00'"

UNIQUE_KEYS = [
    Unique("admin.commune_epci", ("commune_id", "epci_id")),
    Unique("admin.commune", ("code_insee",)),
    Unique("admin.departement", ("code",)),
    Unique("admin.epci", ("code",)),
    Unique("admin.icp_departement", ("code",)),
    Unique("admin.ifn_commune", ("code_insee",)),
    Unique("admin.ifn_departement", ("code",)),
    Unique("admin.insee_cp", ("code_postal", "code_insee")),
    Unique("admin.insee_historique", ("code_insee_ancien", "code_insee_nouveau")),
    Unique("admin.region", ("code",)),
    Unique("admin.zonage", ("code", "code_insee")),
    Unique("main.activites_coop", ("coop_id",)),
    Unique("main.adresse", ("code_ban",)),
    Unique("main.contact_structure_administrative", ("structure_administrative_id", "contact_id")),
    Unique("main.lieu_inclusion", ("structure_cartographie_nationale_id",)),
    Unique("main.lieu_inclusion", ("old_main_structure_id",)),
    Unique("main.lieu_inclusion_structure_administrative", ("lieu_id", "structure_administrative_id")),
    Unique("main.lieu_inclusion", ("structure_coop_id",)),
    Unique("main.personne", ("aidant_connect_id",)),
    Unique("main.personne", ("cn_pg_id",)),
    Unique("main.personne", ("conseiller_numerique_id",)),
    Unique("main.personne", ("coop_id",)),
    Unique("main.poste", ("poste_conum_id", "structure_id", "personne_id")),
    Unique("main.structure_administrative", ("old_main_structure_id",)),
    Unique("main.structure_administrative", ("ridet",)),
    Unique("main.structure_administrative", ("siret", "denomination_antenne"), nulls_equal=True),
    Unique("main.structure_administrative", ("structure_ac_id",)),
    Unique("main.structure_administrative", ("structure_coop_id",)),
    Unique("main.structure_administrative", ("structure_tp_id",)),
    Unique("main.structure", ("structure_cartographie_nationale_id",)),
    Unique("main.structure", ("structure_ac_id",)),
    Unique("main.structure", ("structure_coop_id",)),
    Unique("main.structure", ("structure_tp_id",)),
    Unique("main.structure", ("siret", "nom", "adresse_id")),
    Unique("reference.categories_juridiques", ("code",)),
    Unique("reference.naf", ("code",)),
    Unique("admin.zonage", ("code_insee",), where="type = 'FRR'"),
    Unique(
        "main.adresse",
        ("code_postal", "nom_commune", "nom_voie", "coalesce(cast(numero_voie as int), 0)", "coalesce(repetition, '')"),
        nulls_equal=True,
    ),
    Unique("main.coordination_mediation", ("coordinateur_id", "mediateur_id", f"coalesce(suppression, {SENTINEL})")),
    Unique("main.personne_affectations_emploi", ("personne_id", "structure_administrative_id", "source")),
    Unique("main.personne_affectations_lieu", ("personne_id", "lieu_id", "source")),
    Unique("main.personne_affectations", ("structure_id", "personne_id", "type", "source")),
    Unique("main.structure", ("structure_cartographie_nationale_id", "source")),
    Unique("main.structure", ("siret", "nom", "coalesce(adresse_id, 0)")),
    Unique("min.demande_de_subvention", ("action_id",)),
    Unique("min.utilisateur", ("sso_email",)),
    Unique("min.utilisateur", ("sso_id",)),
]

# --------------------------------------------------------------------------
# Foreign keys.
# --------------------------------------------------------------------------
FOREIGN_KEYS = [
    ForeignKey("admin.commune", "departement_id", "admin.departement", "id"),
    ForeignKey("admin.commune_epci", "commune_id", "admin.commune", "id"),
    ForeignKey("admin.commune_epci", "epci_id", "admin.epci", "id"),
    ForeignKey("admin.departement", "region_id", "admin.region", "id"),
    ForeignKey("admin.zonage", "code_insee", "admin.commune", "code_insee"),
    ForeignKey("main.activites_coop", "lieu_id", "main.lieu_inclusion", "id", "SET NULL"),
    ForeignKey("main.activites_coop", "personne_id", "main.personne", "id"),
    ForeignKey("main.contact_structure_administrative", "structure_administrative_id", "main.structure_administrative", "id", "CASCADE"),
    ForeignKey("main.contact_structure_administrative", "contact_id", "main.contact", "id", "CASCADE"),
    ForeignKey("main.contrat", "personne_id", "main.personne", "id"),
    ForeignKey("main.contrat", "structure_id", "main.structure_administrative", "id"),
    ForeignKey("main.coordination_mediation", "coordinateur_id", "main.personne", "id"),
    ForeignKey("main.coordination_mediation", "mediateur_id", "main.personne", "id"),
    ForeignKey("main.formation", "personne_id", "main.personne", "id", "CASCADE"),
    ForeignKey("main.lieu_inclusion", "adresse_id", "main.adresse", "id"),
    ForeignKey("main.lieu_inclusion_structure_administrative", "structure_administrative_id", "main.structure_administrative", "id", "CASCADE"),
    ForeignKey("main.lieu_inclusion_structure_administrative", "lieu_id", "main.lieu_inclusion", "id", "CASCADE"),
    ForeignKey("main.personne_affectations_emploi", "structure_administrative_id", "main.structure_administrative", "id"),
    ForeignKey("main.personne_affectations_emploi", "personne_id", "main.personne", "id"),
    ForeignKey("main.personne_affectations_lieu", "lieu_id", "main.lieu_inclusion", "id"),
    ForeignKey("main.personne_affectations_lieu", "personne_id", "main.personne", "id"),
    ForeignKey("main.personne_affectations", "personne_id", "main.personne", "id"),
    ForeignKey("main.personne_affectations", "structure_id", "main.structure", "id"),
    ForeignKey("main.poste", "personne_id", "main.personne", "id"),
    ForeignKey("main.poste", "structure_id", "main.structure_administrative", "id"),
    ForeignKey("main.structure_administrative", "adresse_id", "main.adresse", "id"),
    ForeignKey("main.structure_administrative", "categorie_juridique", "reference.categories_juridiques", "code"),
    ForeignKey("main.structure", "adresse_id", "main.adresse", "id"),
    ForeignKey("main.structure", "categorie_juridique", "reference.categories_juridiques", "code"),
    ForeignKey("main.subvention", "poste_id", "main.poste", "id", "CASCADE"),
    ForeignKey("min.action", "createur_id", "min.utilisateur", "id", "RESTRICT"),
    ForeignKey("min.action", "feuille_de_route_id", "min.feuille_de_route", "id", "RESTRICT"),
    ForeignKey("min.beneficiaire_subvention", "demande_de_subvention_id", "min.demande_de_subvention", "id", "RESTRICT"),
    ForeignKey("min.beneficiaire_subvention", "membre_id", "min.membre", "id", "RESTRICT"),
    ForeignKey("min.co_financement", "id_action", "min.action", "id", "RESTRICT"),
    ForeignKey("min.co_financement", "id_membre", "min.membre", "id", "RESTRICT"),
    ForeignKey("min.comite", "editeur_utilisateur_id", "min.utilisateur", "sso_id", "RESTRICT"),
    ForeignKey("min.comite", "gouvernance_departement_code", "min.gouvernance", "departement_code", "RESTRICT"),
    ForeignKey("min.demande_de_subvention", "action_id", "min.action", "id", "RESTRICT"),
    ForeignKey("min.demande_de_subvention", "createur_id", "min.utilisateur", "id", "RESTRICT"),
    ForeignKey("min.demande_de_subvention", "enveloppe_financement_id", "min.enveloppe_financement", "id", "RESTRICT"),
    ForeignKey("min.departement_enveloppe", "departement_code", "min.departement", "code", "RESTRICT"),
    ForeignKey("min.departement_enveloppe", "enveloppe_id", "min.enveloppe_financement", "id", "RESTRICT"),
    ForeignKey("min.departement", "region_code", "min.region", "code", "RESTRICT"),
    ForeignKey("min.feuille_de_route", "editeur_utilisateur_id", "min.utilisateur", "sso_id", "SET NULL"),
    ForeignKey("min.feuille_de_route", "gouvernance_departement_code", "min.gouvernance", "departement_code", "RESTRICT"),
    ForeignKey("min.feuille_de_route", "porteur_id", "min.membre", "id", "SET NULL"),
    ForeignKey("min.gouvernance", "departement_code", "min.departement", "code", "RESTRICT"),
    ForeignKey("min.gouvernance", "editeur_note_de_contexte_id", "min.utilisateur", "sso_id", "SET NULL"),
    ForeignKey("min.gouvernance", "editeur_note_privee_id", "min.utilisateur", "sso_id", "SET NULL"),
    ForeignKey("min.membre", "gouvernance_departement_code", "min.gouvernance", "departement_code", "RESTRICT"),
    ForeignKey("min.membre", "structure_id", "main.structure_administrative", "id"),
    ForeignKey("min.porteur_action", "action_id", "min.action", "id", "RESTRICT"),
    ForeignKey("min.porteur_action", "membre_id", "min.membre", "id", "RESTRICT"),
    ForeignKey("min.structure", "departement_code", "min.departement", "code", "RESTRICT"),
    ForeignKey("min.utilisateur", "departement_code", "min.departement", "code", "SET NULL"),
    ForeignKey("min.utilisateur", "groupement_id", "min.groupement", "id", "SET NULL"),
    ForeignKey("min.utilisateur", "region_code", "min.region", "code", "SET NULL"),
    ForeignKey("min.utilisateur", "structure_id", "main.structure_administrative", "id"),
]

# --------------------------------------------------------------------------
# Allowed values of coded columns.
# --------------------------------------------------------------------------
DOMAINS = {
    ("main.personne_affectations_emploi", "source"): ("idposte", "aidants-connect", "coop", "min"),
    ("main.personne_affectations_lieu", "source"): ("coop", "aidants-connect", "carto", "min"),
    ("main.personne_affectations", "source"): ("idposte", "aidants-connect", "coop"),
    ("main.personne_affectations", "type"): ("structure_emploi", "lieu_activite"),
    ("main.poste", "etat"): ("vacant", "occupe", "rendu"),
    ("main.poste", "typologie"): ("conum", "coordo", "dns"),
    ("main.formation", "label"): ("CCP1", "CCP2", "CCP2 & CCP3"),
    ("main.formation", "parcours"): ("70h", "175h", "315h", "105h", "420h", "280h", "350h"),
    ("main.contrat", "type"): ("CDD", "CDI", "CDP", "PEC"),
    ("min.utilisateur", "role"): (
        "administrateur_dispositif",
        "gestionnaire_departement",
        "gestionnaire_groupement",
        "gestionnaire_region",
        "gestionnaire_structure",
    ),
    ("admin.zonage", "type"): ("QPV", "FRR"),
}

# Row rules that are not plain domains.
CHECKS = [
    Check("main.poste", "poste_rendu", "not (etat = 'rendu' and date_rendu_poste is null)"),
    Check("main.structure_administrative", "siret_format", r"siret is null or siret rlike '^[0-9]{14}$'"),
    Check("main.structure_administrative", "ridet_format", r"ridet is null or ridet rlike '^[0-9]{7,10}$'"),
    Check("main.structure", "siret_format", r"siret rlike '^[0-9]{14}$'"),
]

# --------------------------------------------------------------------------
# Required columns besides the primary key.
# --------------------------------------------------------------------------
REQUIRED_COLUMNS = {
    "admin.commune": "geom departement_id code_insee nom",
    "admin.departement": "geom region_id code nom",
    "admin.region": "geom code nom",
    "admin.commune_epci": "commune_id epci_id",
    "admin.epci": "geom code type nom",
    "admin.icp_departement": "code",
    "admin.ifn_commune": "code_insee score",
    "admin.ifn_departement": "code score",
    "admin.insee_cp": "code_insee code_postal",
    "admin.insee_historique": "code_insee_ancien code_insee_nouveau",
    "admin.zonage": "code_insee type",
    "main.adresse": "code_postal code_insee nom_commune",
    "main.lieu_inclusion": "nom",
    "main.lieu_inclusion_structure_administrative": "lieu_id structure_administrative_id",
    "main.personne": "is_referent_ac",
    "main.personne_affectations": "personne_id type source est_active",
    "main.personne_affectations_emploi": "personne_id structure_administrative_id source est_active",
    "main.personne_affectations_lieu": "personne_id lieu_id source est_active",
    "main.structure": "nom",
    "main.activites_coop": "type date duree type_lieu accompagnements",
    "main.poste": "poste_conum_id date_attribution",
    "main.contrat": "personne_id",
    "main.subvention": "poste_id",
    "main.formation": "personne_id",
    "main.coordination_mediation": "coordinateur_id mediateur_id coordinateur_coop_id mediateur_coop_id",
    "main.contact": "nom prenom email telephone fonction est_referent_fne",
    "main.contact_structure_administrative": "structure_administrative_id contact_id",
    "min.structure": "adresse code_postal commune contact departement_code identifiant_etablissement id_mongo nom statut type",
    "min.utilisateur": "date_de_creation email_de_contact invite_le is_super_admin is_supprime nom prenom role sso_id sso_email telephone",
    "min.membre": "gouvernance_departement_code statut old_uuid is_coporteur",
    "min.action": "createur_id nom contexte description budget_global feuille_de_route_id date_de_debut date_de_fin creation derniere_modification",
    "min.demande_de_subvention": "createur_id statut subvention_demandee action_id enveloppe_financement_id creation derniere_modification",
    "min.co_financement": "id_action id_membre montant",
    "min.comite": "gouvernance_departement_code creation derniere_edition type frequence editeur_utilisateur_id",
    "min.contact_membre_gouvernance": "prenom nom fonction",
    "min.enveloppe_financement": "libelle date_debut date_fin montant",
    "min.departement_enveloppe": "plafond",
    "min.feuille_de_route": "gouvernance_departement_code creation nom",
    "min.departement": "region_code nom",
    "min.groupement": "nom",
    "min.region": "nom",
    "reference.categories_juridiques": "code nom niveau",
    "reference.naf": "code intitule_long intitule_court",
}

# Longest text a column takes.
MAX_LENGTHS = {
    "admin.commune": {"statut": 24, "code_insee": 5, "nom": 50, "code_insee_cr": 5},
    "admin.departement": {"code": 3, "nom": 30},
    "admin.region": {"code": 2, "nom": 35},
    "admin.epci": {"code": 9, "type": 32, "nom": 90},
    "admin.icp_departement": {"code": 3},
    "admin.ifn_commune": {"code_insee": 5},
    "admin.ifn_departement": {"code": 3},
    "admin.insee_cp": {"code_insee": 5, "code_postal": 5},
    "admin.insee_historique": {"code_insee_ancien": 5, "code_insee_nouveau": 5},
    "admin.zonage": {"code": 8, "libelle": 255, "code_insee": 5, "type": 3},
    "main.adresse": {"clef_interop": 50, "code_postal": 5, "code_insee": 5, "nom_commune": 255, "nom_voie": 255, "repetition": 10, "departement": 3},
    "main.lieu_inclusion": {"nom": 255, "edited_by": 50},
    "main.lieu_inclusion_structure_administrative": {"edited_by": 50},
    "main.personne": {"prenom": 50, "nom": 50, "conseiller_numerique_id": 50, "edited_by": 50},
    "main.structure_administrative": {"siret": 14, "ridet": 10, "rna": 10, "denomination_antenne": 255, "code_activite_principale": 6, "categorie_juridique": 4, "edited_by": 50},
    "main.structure": {"nom": 255, "siret": 14, "rna": 10, "code_activite_principale": 6, "categorie_juridique": 4, "edited_by": 50},
    "main.activites_coop": {"type": 100, "lieu_code_insee": 5, "type_lieu": 100, "autonomie": 100, "structure_de_redirection": 255, "degre_de_finalisation_demarche": 50, "titre_atelier": 255, "niveau_atelier": 50},
    "main.poste": {"typologie": 6, "action_coselec": 255, "etat": 6},
    "main.contrat": {"type": 3},
    "main.formation": {"label": 11, "parcours": 4, "marche_formation": 8, "lieu": 255},
    "main.contact": {"nom": 255, "prenom": 255, "email": 255, "telephone": 20, "fonction": 255},
    "min.structure": {"categorie_juridique": 4},
    "min.utilisateur": {"telephone": 13},
    "reference.categories_juridiques": {"code": 4, "nom": 150},
    "reference.naf": {"code": 6, "intitule_long": 150, "intitule_court": 65},
}

# --------------------------------------------------------------------------
# Access policy.
# --------------------------------------------------------------------------
TIER_1 = (
    "main.personne",
    "main.contact",
    "main.contact_structure_administrative",
    "min.utilisateur",
    "min.contact_membre_gouvernance",
    "min.membre",
    "min.personne_enrichie",
)
TIER_2 = (
    "main.personne_affectations",
    "main.personne_affectations_emploi",
    "main.personne_affectations_lieu",
    "main.formation",
    "main.contrat",
    "main.coordination_mediation",
    "main.poste",
    "main.activites_coop",
    "min.postes_conseiller_numerique_synthese",
    "min.beneficiaire_subvention",
    "min.co_financement",
    "min.porteur_action",
    "min.demande_de_subvention",
    "min.action",
    "min.comite",
    "min.feuille_de_route",
    "min.gouvernance",
)
TIER_3 = (
    "main.structure",
    "main.structure_administrative",
    "main.lieu_inclusion",
    "main.adresse",
    "min.structure",
)
TECHNICAL = ("min._prisma_migrations",)
NO_REPLACEMENT = (
    "main.structure",
    "min.contact_membre_gouvernance",
    "main.lieu_inclusion",
    "main.adresse",
)
SAFE_VIEWS = (
    "llm.personne",
    "llm.contact",
    "llm.structure_administrative",
    "llm.utilisateur",
    "llm.structure",
    "llm.membre",
    "llm.personne_enrichie",
)
INCLUDE_PATTERNS = (
    "admin.*",
    "reference.*",
    "llm.*",
    "main.subvention",
    "main.lieu_inclusion_structure_administrative",
    "min.departement",
    "min.region",
    "min.groupement",
    "min.enveloppe_financement",
    "min.departement_enveloppe",
)
EXCLUDED = TIER_1 + TIER_2 + TIER_3 + TECHNICAL

# Columns each safe view withholds.
WITHHELD = {
    "llm.personne": ("prenom", "nom", "contact", "edited_by", "deleted_by"),
    "llm.contact": ("nom", "prenom", "email", "telephone"),
    "llm.utilisateur": ("nom", "prenom", "email_de_contact", "sso_email", "sso_id", "telephone"),
    "llm.structure": ("contact", "adresse"),
    "llm.membre": ("contact", "contact_technique"),
    "llm.personne_enrichie": ("prenom", "nom", "contact", "edited_by", "deleted_by"),
}
# Columns each safe view shows; a column that is not listed is not shown.
_PERSON = """id aidant_connect_id conseiller_numerique_id cn_pg_id coop_id is_coordinateur is_mediateur formation_fne_ac profession_ac
    nb_accompagnements_ac created_at updated_at deleted_at"""
SHOWN = {
    "llm.personne": f"{_PERSON} is_referent_ac updated_at_ac is_visible updated_at_coop updated_at_idposte",
    "llm.contact": "id fonction est_referent_fne created_at updated_at",
    # The contact is shown reduced to the keys below. The department is the one that the documented queries group by.
    "llm.structure_administrative": """id old_main_structure_id siret ridet denomination_sirene rna denomination_antenne adresse_id structure_coop_id
        structure_tp_id structure_ac_id etat_administratif code_activite_principale categorie_juridique publique nb_mandats_ac contact deleted_at
        deleted_by edited_by last_sirene_enrich_at created_at updated_at updated_at_coop updated_at_idposte updated_at_ac departement_code""",
    "llm.utilisateur": """id date_de_creation departement_code derniere_connexion groupement_id invite_le is_super_admin is_supprime region_code role
        old_structure_id structure_id""",
    "llm.structure": "id code_postal commune departement_code identifiant_etablissement id_mongo nom statut type categorie_juridique",
    "llm.membre": """id gouvernance_departement_code type statut old_uuid is_coporteur categorie_membre nom siret_ridet date_suppression
        old_structure_id structure_id""",
    "llm.personne_enrichie": f"""{_PERSON} type_accompagnateur labellisation_aidant_connect est_actuellement_mediateur_en_poste
        est_actuellement_aidant_numerique_en_poste est_actuellement_conseiller_numerique est_actuellement_coordo_actif structure_employeuse_id""",
}
ORG_CONTACT_KEYS = ("site_web", "telephone")
PII_COLUMNS = (
    "nom", "prenom", "email", "email_de_contact", "sso_email", "courriels", "telephone",
    "contact", "contact_technique", "adresse", "nom_voie", "numero_voie",
)
IDENTIFIER_COLUMNS = ("personne_id", "coop_id", "structure_id")
SENSITIVE_NEEDLES = ("@example.com", "prenom", "sso_email", "telephone")
MAX_ROWS = 10_000
TOP_K = 20


def tier_of(table: str) -> int | None:
    """Access tier that refuses a table, or None where it is not refused by name."""
    for tier, names in ((1, TIER_1), (2, TIER_2), (3, TIER_3)):
        if table in names:
            return tier
    return None
