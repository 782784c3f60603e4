"""Declared rules as jobs, deletions that spread, change stamps."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_checks.base import check
from maillage import model
from maillage.operators import quality, upserts
from maillage.operators.ordering import latest_by
from maillage.session import scratch_path

STAMP = "2026-01-01 00:00:00"


@check("dq_check", "select id, date_fin, date_debut from a_contrat where date_rupture <= date_debut or date_fin < date '1998-01-01'")
def _(t):
    rule = "not (date_rupture <= date_debut) and date_fin >= date'1998-01-01'"
    # As in SQL, an AND with an unknown part is false once the other part is.
    return quality.dq_check(t.a_contrat, rule).select("id", "date_fin", "date_debut")


@check("dq_poste_rendu", "select id from a_poste where etat = 'rendu' and date_rendu_poste is null")
def _(t):
    rule = next(c for c in model.CHECKS if c.name == "poste_rendu")
    return quality.dq_check(t.a_poste, rule.predicate).select("id")


@check("dq_siret", """
    select id from a_structure where siret is not null and not regexp_full_match(substr(siret, 2) || cast(id as varchar), '[0-9]{14}')""")
def _(t):
    # Thirteen digits and the id: right for one-digit ids only.
    grown = t.a_structure.withColumn("siret", F.expr("concat(substr(siret, 2), cast(id as string))"))
    rule = next(c for c in model.CHECKS if c.table == "main.structure_administrative" and c.name == "siret_format")
    return quality.dq_check(grown, rule.predicate).select("id")


@check("dq_ridet", "select s_suppkey as id from supplier where length(cast(s_suppkey as varchar)) < 3")
def _(t):
    padded = t.supplier.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("9876"), F.col("s_suppkey").cast("string")).alias("ridet"))
    rule = next(c for c in model.CHECKS if c.name == "ridet_format")
    return quality.dq_check(padded, rule.predicate).select("id")


@check("dq_domain", "select id, source from a_emploi where source not in ('idposte', 'aidants-connect', 'coop')")
def _(t):
    allowed = model.DOMAINS[("main.personne_affectations", "source")]
    return quality.dq_domain(t.a_emploi, "source", allowed).select("id", "source")


@check("dq_not_null", "select id from a_poste where structure_id is null or created_at is null")
def _(t):
    return quality.dq_not_null(t.a_poste, ["structure_id", "created_at"]).select("id")


@check("dq_length", "select doc_id from documents where length(text) > 4000 or length(source) > 4")
def _(t):
    return quality.dq_length(t.documents, {"text": 4000, "source": 4}).select("doc_id")


@check("dq_unique", "select l_orderkey as k1, l_linenumber as k2, count(*) as nb from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    return quality.dq_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@check("dq_unique_nulls_equal", """
    select siret as k1, coalesce(denomination_antenne, 'x') = 'x' as k2, count(*) as nb
    from (select siret, case when denomination_antenne is null then null else 'autre' end as denomination_antenne from a_structure_administrative
          union all select siret, null from a_structure) s
    group by siret, denomination_antenne having count(*) > 1""")
def _(t):
    rows = t.a_structure_administrative.select("siret", F.when(F.col("denomination_antenne").isNotNull(), "autre").alias("antenne")).unionByName(
        t.a_structure.select("siret", F.lit(None).cast("string").alias("antenne"))
    )
    out = quality.dq_unique(rows, ["siret", "antenne"], nulls_equal=True)
    return out.withColumn("k2", F.col("k2").isNull())


@check("dq_unique_partial", """
    select lieu_code_insee as k1, count(*) as nb from a_activites where type = 'individuel' group by 1 having count(*) > 1""")
def _(t):
    return quality.dq_unique(t.a_activites, ["lieu_code_insee"], where="type = 'individuel'")


@check("dq_unique_expr", """
    select coordinateur_id as k1, mediateur_id as k2, count(*) as nb from a_coordination
    group by coordinateur_id, mediateur_id, coalesce(suppression, date '1234-01-02') having count(*) > 1""")
def _(t):
    keys = ["coordinateur_id", "mediateur_id", "coalesce(suppression, date'1234-01-02')"]
    return quality.dq_unique(t.a_coordination, keys).drop("k3")


@check("dq_primary_key", """
    select structure_id as k1, personne_id as k2, count(*) as nb from a_poste
    group by 1, 2 having count(*) > 1 or structure_id is null or personne_id is null""")
def _(t):
    return quality.dq_primary_key(t.a_poste, ["structure_id", "personne_id"])


@check("dq_foreign_key", """
    select e.id, e.structure_administrative_id from a_emploi e where e.structure_administrative_id is not null
      and not exists (select 1 from a_structure_administrative s where s.id = e.structure_administrative_id and s.departement_code < '20')""")
def _(t):
    parents = t.a_structure_administrative.where("departement_code < '20'")
    return quality.dq_foreign_key(t.a_emploi, "structure_administrative_id", parents, "id").select("id", "structure_administrative_id")


# Tables of the model that the given data can fill: adapter and its columns.
REPORTED = {
    "admin.region": ("a_region", "id code nom"),
    "admin.departement": ("a_departement", "id region_id code nom"),
    "admin.commune": ("a_commune", "id departement_id code_insee nom population"),
    "admin.ifn_commune": ("a_ifn_commune", "code_insee score"),
    "admin.zonage": ("a_zonage", "code_insee type code"),
    "admin.insee_historique": ("a_insee_historique", "code_insee_ancien code_insee_nouveau"),
    "main.structure_administrative": ("a_structure_administrative", "id denomination_sirene siret denomination_antenne contact old_main_structure_id departement_code"),
    "main.structure": (
        "a_structure", "id nom structure_coop_id structure_ac_id structure_cartographie_nationale_id denomination_sirene siret source emplois"
        " last_sirene_enrich_at typologies_texte frais_texte",
    ),
    "main.personne": (
        "a_personne", "id prenom nom contact aidant_connect_id cn_pg_id coop_id is_coordinateur is_mediateur nb_accompagnements_ac profession_ac edited_by deleted_by",
    ),
    "main.personne_affectations_emploi": ("a_emploi", "id personne_id structure_administrative_id source est_active"),
    "main.personne_affectations": ("a_links", "id personne_id structure_id type structure_coop_id mediateur_coop_id suppression"),
    "main.poste": ("a_poste", "id poste_conum_id structure_id personne_id etat typologie date_attribution date_rendu_poste created_at"),
    "main.contrat": ("a_contrat", "id personne_id structure_id date_debut date_fin date_rupture"),
    "main.subvention": (
        "a_subvention", "poste_id montant_subvention_v1 montant_subvention_v2 montant_bonification_v2 montant_versement_v1 versement_1_v2 versement_2_v2"
        " versement_3_v2 date_fin_convention_dgcl date_fin_convention_ditp date_fin_convention_dge",
    ),
    "main.activites_coop": ("a_activites", "id personne_id type date duree lieu_code_insee accompagnements sujet beneficiaires"),
    "main.adresse": ("a_adresse", "id code_postal nom_commune nom_voie numero_voie repetition"),
    "main.coordination_mediation": ("a_coordination", "id coordinateur_id mediateur_id coordinateur_coop_id mediateur_coop_id suppression"),
    "main.formation": ("a_formation", "id personne_id label parcours"),
    "min.action": ("a_action", "id feuille_de_route_id budget_global"),
    "min.feuille_de_route": ("a_feuille", "id gouvernance_departement_code"),
    "min.demande_de_subvention": ("a_demande", "action_id enveloppe_financement_id subvention_demandee"),
    "min.co_financement": ("a_cofinancement", "id_action id_membre montant"),
    "min.enveloppe_financement": ("a_enveloppe", "id libelle montant"),
    "min.departement_enveloppe": ("a_plafond", "departement_code enveloppe_id plafond"),
    "min.region": ("a_region", "id code nom"),
    "min.departement": ("a_departement", "id region_id code nom"),
}


def _report_sql() -> str:
    """One count per declared rule, each by a query of its own."""
    checks = {  # what breaks them, and the columns they read
        "poste_rendu": ("etat = 'rendu' and date_rendu_poste is null", "etat date_rendu_poste"),
        "siret_format": ("not regexp_full_match(siret, '[0-9]{14}')", "siret"),
        "ridet_format": ("not regexp_full_match(ridet, '[0-9]{7,10}')", "ridet"),
    }
    selects = []

    def put(table: str, rule: str, sql: str | None, missing: str = "column") -> None:
        name, count = (rule, f"({sql})") if sql else (f"missing_{missing}:{rule}", "cast(null as bigint)")
        selects.append(f"""select '{table}' as table_name, '{name.replace("'", "''")}' as rule, {count} as violations""")

    for table, (source, listed) in REPORTED.items():
        columns = set(listed.split())

        def broken(rule: str, condition: str, *needs: str, table=table, source=source, columns=columns) -> None:
            put(table, rule, f"select count(*) from {source} where {condition}" if columns.issuperset(needs) else None)

        for c in model.CHECKS:
            if c.table == table:
                broken(f"check:{c.name}", checks[c.name][0], *checks[c.name][1].split())
        for (owner, column), allowed in model.DOMAINS.items():
            if owner == table:
                values = ", ".join(f"'{v}'" for v in allowed)
                broken(f"domain:{column}", f"{column} not in ({values})", column)
        key = model.primary_key(table)
        for column in dict.fromkeys([*key, *model.REQUIRED_COLUMNS.get(table, "").split()]):
            broken(f"not_null:{column}", f"{column} is null", column)
        for column, longest in model.MAX_LENGTHS.get(table, {}).items():
            broken(f"length:{column}", f"length({column}) > {longest}", column)
        keys = [(f"unique:{', '.join(u.keys)}" + (f" where {u.where}" if u.where else ""), u) for u in model.UNIQUE_KEYS if u.table == table]
        for rule, u in [*keys, (f"primary_key:{', '.join(key)}", model.Unique(table, key))]:
            parts = [k.replace(model.SENTINEL, "timestamp '1234-01-02 03:04:05'") for k in u.keys]
            plain = [k.split("(")[-1].split(" ")[0].split(",")[0] for k in parts]
            condition = " and ".join(["true", *([] if u.nulls_equal else [f"{k} is not null" for k in parts]), *([u.where] if u.where else [])])
            sql = f"select count(*) from (select 1 from {source} where {condition} group by {', '.join(parts)} having count(*) > 1) x"
            put(table, rule, sql if columns.issuperset(plain) else None)
        for fk in model.FOREIGN_KEYS:
            if fk.child == table:
                parent, has = REPORTED.get(fk.parent, ("", ""))
                sql = f"""select count(*) from {source} c where c.{fk.column} is not null and not exists (
                    select 1 from {parent} p where cast(p.{fk.parent_column} as varchar) = cast(c.{fk.column} as varchar))"""
                fits = fk.column in columns and fk.parent_column in has.split()
                put(table, f"foreign_key:{fk.column}", sql if parent and fits else None, "column" if parent else "table")
    return " union all ".join(selects)


@check("dq_report", _report_sql())
def _(t):
    return quality.dq_report({name: getattr(t, source) for name, (source, _) in REPORTED.items()})


@check("cascade_delete", """
    select l.l_orderkey as id, count(*) as nb from lineitem l
    where exists (select 1 from orders o join customer c on c.c_custkey = o.o_custkey where o.o_orderkey = l.l_orderkey and c.c_acctbal >= 0)
    group by 1""")
def _(t):
    # customer -> orders -> lineitem, both links cascading.
    gone = t.customer.where("c_acctbal < 0")
    orders_gone = quality.cascade_delete(t.orders, "o_custkey", gone, "c_custkey", "RESTRICT")
    kept = quality.cascade_delete(t.lineitem, "l_orderkey", orders_gone, "o_orderkey", "CASCADE")
    return kept.groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("nb"))


@check("cascade_set_null", """
    select o_orderkey as id, case when c.c_acctbal < 0 then null else o_custkey end as o_custkey
    from orders o left join customer c on c.c_custkey = o.o_custkey""")
def _(t):
    gone = t.customer.where("c_acctbal < 0")
    return quality.cascade_delete(t.orders, "o_custkey", gone, "c_custkey", "SET NULL").select(F.col("o_orderkey").alias("id"), "o_custkey")


# Positions attributed before 1999 are loaded; the contracts' dates update them and add the others.
@check("upsert", f"""
    select coalesce(p.id, c.id) as id,
      case when c.id is not null then c.date_debut + 10 else p.date_attribution end as date_attribution,
      case when p.id is not null and c.id is not null and (c.date_debut + 10) is distinct from p.date_attribution then timestamp '{STAMP}' end as updated_at
    from (select * from a_poste where date_attribution < date '1999-01-01') p full join (select * from a_contrat where date_fin is not null) c on c.id = p.id""")
def _(t):
    target = t.a_poste.where("date_attribution < date'1999-01-01'").select(
        "id", "date_attribution", F.lit(None).cast("timestamp_ntz").alias("updated_at")
    )
    late = t.a_contrat.where("date_fin is not null").select(
        "id", F.expr("date_debut + 10").alias("date_attribution"), F.lit(None).cast("timestamp_ntz").alias("updated_at"), F.lit(2).alias("v")
    )
    early = late.withColumn("date_attribution", F.lit("1990-01-01").cast("date")).withColumn("v", F.lit(1))
    stored = upserts.StoredTarget(scratch_path(t.spark, "positions"), ("id",), 16)
    stored.write(target)
    stored.upsert(late.unionByName(early), "v", F.lit(STAMP).cast("timestamp_ntz"))
    return stored.read(t.spark)


@check("latest_by_source_clock", """
    select distinct on (personne_id) personne_id, id, etat from a_poste
    order by personne_id, greatest(date_attribution, date_rendu_poste) desc nulls last, id""")
def _(t):
    return latest_by(t.a_poste, ["personne_id"], ["date_attribution", "date_rendu_poste"], "id").select("personne_id", "id", "etat")


@check("stamp_updated_at", f"""
    select id, case when etat = 'vacant' then 'occupe' else etat end as etat,
      case when etat = 'vacant' then timestamp '{STAMP}' else created_at end as updated_at from a_poste""")
def _(t):
    before = t.a_poste.select("id", "etat", F.col("created_at").alias("updated_at"))
    after = before.withColumn("etat", F.when(F.col("etat") == "vacant", "occupe").otherwise(F.col("etat")))
    return upserts.stamp_updated_at(before, after, "id", F.lit(STAMP).cast("timestamp_ntz"))


@check("stamp_edited_by", "select id, case when is_mediateur then 'coop' else edited_by end as edited_by from a_personne")
def _(t):
    return upserts.stamp_edited_by(t.a_personne, "coop", F.col("is_mediateur")).select("id", "edited_by")


@check("append_deleted_by", """
    select id, case when is_mediateur and deleted_by <> 'MACHINERY' then deleted_by || ',MACHINERY' else deleted_by end as deleted_by from a_personne""")
def _(t):
    marked = t.a_personne.select("id", "is_mediateur", F.array("deleted_by").alias("deleted_by"))
    out = upserts.append_deleted_by(marked, "MACHINERY", F.col("is_mediateur"))
    return out.select("id", F.array_join("deleted_by", ",").alias("deleted_by"))
