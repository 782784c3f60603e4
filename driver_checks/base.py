"""The given tables in the shape of the data model, and the register of queries.

An adapter is a projection valid in Spark SQL and in DuckDB, so both sides start from
the same rows. Keys are derived from keys, so every adapter grows with its table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from maillage.session import configure

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

CODE_INSEE = (
    "case when s_suppkey % 10 = 0 then concat('97', lpad(cast(s_suppkey % 1000 as string), 3, '0'))"
    " else lpad(cast(s_suppkey as string), 5, '0') end"
)

ADAPTERS = {
    "a_region": "select r_regionkey as id, lpad(cast(r_regionkey as string), 2, '0') as code, r_name as nom from {region}",
    "a_departement": """
        select n_nationkey as id, n_regionkey as region_id, lpad(cast(n_nationkey as string), 2, '0') as code, n_name as nom
        from {nation}""",
    "a_commune": f"""
        select s_suppkey as id, s_nationkey as departement_id, {CODE_INSEE} as code_insee, s_name as nom,
          cast(floor(abs(s_acctbal)) as bigint) as population
        from {{supplier}}""",
    "a_ifn_commune": f"""
        select {CODE_INSEE} as code_insee, cast(s_suppkey % 11 as decimal(10,4)) as score
        from {{supplier}} where s_acctbal > 0""",
    "a_zonage": f"""
        select {CODE_INSEE} as code_insee, case when s_acctbal < 1000 then 'QPV' else 'FRR' end as type,
          cast(s_nationkey as string) as code
        from {{supplier}} where s_acctbal < 5000""",
    "a_insee_historique": f"""
        select {CODE_INSEE} as code_insee_ancien, {CODE_INSEE.replace('s_suppkey', '(s_suppkey + 1)')} as code_insee_nouveau
        from {{supplier}} where s_acctbal < 2000""",
    "a_structure_administrative": """
        select s_suppkey as id, s_name as denomination_sirene,
          lpad(cast(cast(floor(s_suppkey / 2) as bigint) as string), 14, '1') as siret,
          case when s_suppkey % 2 = 0 then null else s_name end as denomination_antenne,
          concat('{{"nom":"N', cast(s_suppkey as string), '","site_web":"http://s', cast(s_suppkey as string), '","telephone":"01"}}') as contact,
          case when s_acctbal < 0 then null else s_suppkey + 100000 end as old_main_structure_id,
          lpad(cast(s_nationkey as string), 2, '0') as departement_code
        from {supplier}""",
    "a_personne": """
        select c_custkey as id, concat('P', cast(c_custkey % 40 as string)) as prenom, c_name as nom,
          case when c_custkey % 6 = 0 then '{{ }}' else concat('{{"email":"', c_name, '"}}') end as contact,
          case when c_acctbal < 0 then null else cast(floor(c_custkey / 2) as bigint) end as aidant_connect_id,
          case when c_acctbal < 5000 then null else cast(floor(c_custkey / 3) as bigint) end as cn_pg_id,
          case when c_custkey % 4 = 0 then null else concat('coop-', cast(c_custkey as string)) end as coop_id,
          case c_custkey % 7 when 0 then true when 1 then null else false end as is_coordinateur,
          case c_custkey % 3 when 0 then true when 1 then false else null end as is_mediateur,
          case when c_custkey % 5 = 0 then null else c_custkey % 50 end as nb_accompagnements_ac,
          c_mktsegment as profession_ac, c_mktsegment as edited_by, c_mktsegment as deleted_by
        from {customer}""",
    "a_noms": """
        select c_custkey as id, concat('p', cast(c_custkey % 40 as string), ' ',
          substr(md5(cast(cast(floor(c_custkey / 3) as bigint) as string)), 1, 8),
          case c_custkey % 3 when 0 then '' when 1 then 'e' else 's' end) as nom
        from {customer}""",
    "a_emploi": """
        select o_orderkey as id, o_custkey as personne_id,
          cast(floor((o_custkey + o_orderkey % 7) / 15) as bigint) as structure_administrative_id,
          case o_orderkey % 4 when 0 then 'idposte' when 1 then 'coop' when 2 then 'aidants-connect' else 'min' end as source,
          o_orderstatus <> 'F' as est_active
        from {orders}""",
    "a_poste": """
        select o_orderkey as id, o_custkey as poste_conum_id,
          case when o_orderkey % 50 = 49 then null
            else cast(floor(o_custkey / 15) + floor(cast(substr(o_orderpriority, 1, 1) as int) / 2) as bigint) end as structure_id,
          o_custkey + o_orderkey % 2 as personne_id,
          case o_orderstatus when 'F' then 'rendu' when 'O' then 'occupe' else 'vacant' end as etat,
          case when o_orderpriority like '1%' then 'coordo' else 'conum' end as typologie,
          cast(o_orderdate as date) as date_attribution,
          case when o_orderstatus = 'F' and o_orderpriority not like '1%' then cast(o_orderdate as date) + 90 end as date_rendu_poste,
          case when o_orderkey % 13 = 0 then null else o_orderdate end as created_at
        from {orders}""",
    "a_contrat": """
        select o_orderkey as id, o_custkey as personne_id,
          case when o_orderkey % 50 = 49 then null else cast(floor(o_custkey / 15) + o_orderkey % 3 as bigint) end as structure_id,
          cast(o_orderdate as date) as date_debut,
          case when o_orderkey % 3 = 0 then null else cast(o_orderdate as date) + 365 end as date_fin,
          case when o_orderstatus = 'F' then cast(o_orderdate as date) + 30 end as date_rupture
        from {orders}""",
    "a_subvention": """
        select l_orderkey as poste_id,
          cast(sum(case when l_returnflag = 'A' then l_quantity end) as bigint) as montant_subvention_v1,
          cast(sum(case when l_returnflag = 'R' then l_quantity end) as bigint) as montant_subvention_v2,
          cast(sum(case when l_returnflag = 'R' and l_linenumber = 1 then l_quantity end) as bigint) as montant_bonification_v2,
          cast(sum(case when l_returnflag = 'A' and l_linenumber = 2 then l_quantity end) as bigint) as montant_versement_v1,
          cast(sum(case when l_returnflag = 'R' and l_linenumber = 1 then l_quantity end) as bigint) as versement_1_v2,
          cast(sum(case when l_returnflag = 'R' and l_linenumber = 2 then l_quantity end) as bigint) as versement_2_v2,
          cast(sum(case when l_returnflag = 'R' and l_linenumber = 3 then l_quantity end) as bigint) as versement_3_v2,
          cast(max(case when l_returnflag = 'A' then l_shipdate end) as date) as date_fin_convention_dgcl,
          cast(max(case when l_returnflag = 'R' then l_shipdate end) as date) as date_fin_convention_ditp,
          cast(max(case when l_returnflag = 'N' then l_shipdate end) as date) as date_fin_convention_dge
        from {lineitem} group by l_orderkey""",
    "a_activites": f"""
        select l_orderkey as id, l_partkey as personne_id,
          case l_returnflag when 'A' then 'individuel' when 'N' then 'demarche_administrative' else 'collectif' end as type,
          cast(l_shipdate as date) as date, cast(l_quantity as int) as duree,
          {CODE_INSEE.replace('s_suppkey', 'l_suppkey')} as lieu_code_insee,
          l_linenumber as accompagnements, cast(l_partkey % 12 as int) as sujet,
          concat('{{{{"total":', cast(l_linenumber as string), ',"genres":{{{{"f":', cast(cast(l_quantity as int) as string),
            ',"m":', cast(l_linenumber as string), '}}}},"statuts":{{{{"', lower(l_linestatus), '":1}}}}}}}}') as beneficiaires
        from {{lineitem}}""",
    "a_links": """
        select event_id as id, user_id as personne_id,
          case when value < 15 then null else cast(floor(user_id / 10) as bigint) * 4 + event_id % 4 end as structure_id,
          case when event_type in ('view', 'click') then 'lieu_activite' else 'structure_emploi' end as type,
          case when event_id % 3 = 0 then null
            else concat('s-', cast(cast(floor(user_id / 10) as bigint) * 4 + event_id % 4 as string)) end as structure_coop_id,
          case when event_id % 5 = 0 then null else concat('m-', cast(user_id as string)) end as mediateur_coop_id,
          case when event_type in ('error', 'purchase') then date_trunc('day', ts) else null end as suppression
        from {events}""",
    "a_person_links": """
        select o_orderkey as id, o_custkey as personne_id,
          case when o_orderkey % 11 = 0 then null else o_orderkey % 3 end as structure_id,
          case o_orderkey % 4 when 0 then 'structure_emploi' else 'lieu_activite' end as type,
          case when o_orderstatus = 'F' then date_trunc('year', o_orderdate) else null end as suppression
        from {orders}""",
    "a_link_pairs": """
        select w as winner_id, l as loser_id, concat('s-', cast(l as string)) as loser_coop_id
        from (
          select cast(floor(structure_id / 2) as bigint) as g, min(structure_id) as w, max(structure_id) as l
          from (select case when value < 15 then null else cast(floor(user_id / 10) as bigint) * 4 + event_id % 4 end as structure_id from {events}) s
          where structure_id is not null group by cast(floor(structure_id / 2) as bigint)
        ) p where w <> l""",
    "a_merge_pairs": """
        select winner_id, loser_id
        from (
          select lag(c_custkey) over (partition by c_mktsegment, floor(c_acctbal / 10) order by c_custkey) as winner_id, c_custkey as loser_id
          from {customer}
        ) p where winner_id is not null""",
    # Of every ten customers: two losers in order, a circle, one with two winners, one whose winner is not there.
    "a_conflicting_pairs": """
        select case c_custkey % 10 when 1 then c_custkey - 1 when 2 then c_custkey - 1 when 4 then c_custkey + 1 when 5 then c_custkey - 1
            when 7 then c_custkey - 1 when 9 then c_custkey + 100000000000 end as winner_id, c_custkey as loser_id
        from {customer} where c_custkey % 10 in (1, 2, 4, 5, 7, 9)
        union all select c_custkey + 1, c_custkey from {customer} where c_custkey % 10 = 7""",
    "a_structure_mapping": """
        select l as id, w as root_id
        from (select cast(floor(s_suppkey / 2) as bigint) as g, min(s_suppkey) as w, max(s_suppkey) as l
              from {supplier} group by cast(floor(s_suppkey / 2) as bigint)) p
        where w <> l""",
    "a_structure": """
        select s_suppkey as id, s_name as nom,
          case when s_suppkey % 3 = 0 then null else concat('sc-', cast(s_suppkey as string)) end as structure_coop_id,
          case when s_suppkey % 4 < 2 then null else concat('ac-', cast(s_suppkey as string)) end as structure_ac_id,
          case when s_acctbal < 1000 then null else concat('carto-', cast(s_suppkey as string)) end as structure_cartographie_nationale_id,
          case when s_acctbal < 3000 then null else s_name end as denomination_sirene,
          case when s_acctbal < 2000 then null else lpad(cast(s_suppkey as string), 14, '2') end as siret,
          case when s_suppkey % 5 = 0 then '' when s_suppkey % 5 = 1 then null else 'coop' end as source,
          case when s_acctbal < 4000 then null else s_nationkey end as emplois,
          case when s_acctbal < 0 then null when s_acctbal < 2500 then date '2020-01-01' + cast(s_nationkey as int) end as last_sirene_enrich_at,
          case when s_suppkey % 7 = 0 then null else concat('t', cast(s_nationkey % 4 as string), '||b') end as typologies_texte,
          case when s_acctbal < 1500 then null else concat('f', cast(s_suppkey % 3 as string), '|') end as frais_texte
        from {supplier}""",
    "a_adresse": """
        select c_custkey as id, lpad(cast(c_nationkey as string), 5, '3') as code_postal, c_mktsegment as nom_commune,
          case when c_custkey % 9 = 0 then null else concat('voie ', cast(cast(floor(c_acctbal / 1000) as bigint) as string)) end as nom_voie,
          case when c_custkey % 4 = 0 then null else c_custkey % 4 - 1 end as numero_voie,
          case when c_custkey % 2 = 0 then null else '' end as repetition
        from {customer}""",
    "a_coordination": """
        select o_orderkey as id, o_custkey as coordinateur_id, o_custkey + o_orderkey % 5 as mediateur_id,
          concat('coop-', cast(o_custkey as string)) as coordinateur_coop_id,
          concat('coop-', cast(o_custkey + o_orderkey % 5 as string)) as mediateur_coop_id,
          case when o_orderstatus = 'F' then cast(o_orderdate as date) end as suppression
        from {orders}""",
    "a_formation": """
        select o_orderkey as id, o_custkey as personne_id,
          case o_orderstatus when 'F' then 'CCP1' when 'O' then 'CCP2' else 'CCP2 & CCP3' end as label,
          case substr(o_orderpriority, 1, 1) when '1' then '70h' when '2' then '105h' when '3' then '175h' when '4' then '315h' end as parcours
        from {orders}""",
    "a_action": "select o_orderkey as id, o_custkey as feuille_de_route_id, o_totalprice as budget_global from {orders}",
    "a_requetes": """
        select conv_id * 1000 + turn as id,
          concat('SELECT x.', case (conv_id + turn) % 5 when 0 then 'nom' when 1 then 'id, x.email_de_contact' when 2 then 'nom_commune' when 3 then 'prenom' else 'departement_code' end,
            ' FROM ', case (conv_id * 3 + turn) % 9 when 0 then 'llm.structure' when 1 then 'main.personne' when 2 then 'Main."Poste"' when 3 then 'main.subvention'
              when 4 then 'main.structure' when 5 then 'admin.commune' when 6 then 'llm.personne_enrichie' when 7 then 'audit.journal' else 'reference.naf' end,
            ' x', case (conv_id + turn) % 8 when 0 then ', min.utilisateur u' when 1 then ' join llm.structure_administrative s on s.id = x.id'
              when 2 then ', personne p' when 3 then ' join secret.notes n on true' when 4 then ' join parquet.`/data/personne` on true' when 5 then ', "Poste", admin.commune' else '' end,
            ' where note = ', text) as texte
        from {conversations}""",
    "a_feuille": "select c_custkey as id, lpad(cast(c_nationkey as string), 2, '0') as gouvernance_departement_code from {customer}",
    "a_demande": """
        select l_orderkey as action_id, l_linenumber as enveloppe_financement_id, l_extendedprice as subvention_demandee
        from {lineitem}""",
    "a_cofinancement": "select l_orderkey as id_action, l_suppkey as id_membre, l_extendedprice as montant from {lineitem} where l_discount > 0.02",
    "a_enveloppe": "select n_nationkey as id, n_name as libelle, cast(1000000 * (n_nationkey + 1) as double) as montant from {nation}",
    "a_plafond": """
        select lpad(cast(s_nationkey as string), 2, '0') as departement_code, cast(1 + s_suppkey % 7 as int) as enveloppe_id,
          max(abs(s_acctbal)) as plafond
        from {supplier} group by s_nationkey, cast(1 + s_suppkey % 7 as int)""",
}


def _used(sql: str) -> list[str]:
    return [name for name in GIVEN if "{" + name + "}" in sql]


_SCHEMAS: dict[str, StructType] = {}  # of the given tables, so that each is looked up once and not at every use


class Tables:
    """Given tables and adapters by name, e.g. ``t.orders`` or ``t.a_poste``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in GIVEN:
            path = f"{self.folder}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            return self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        if name in ADAPTERS:
            sql = ADAPTERS[name]
            return self.spark.sql(sql, **{g: getattr(self, g) for g in _used(sql)})
        raise AttributeError(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _adapter_ctes(sql: str) -> list[str]:
    names = [n for n in ADAPTERS if re.search(rf"\b{n}\b", sql)]
    return [f"{n} as ({ADAPTERS[n].format(**{g: g for g in GIVEN})})" for n in names]


def oracle(sql: str) -> str:
    """Prefix the SQL with the adapters it names."""
    sql = sql.strip()
    ctes = _adapter_ctes(sql)
    if not ctes:
        return sql
    head = re.match(r"with(\s+recursive)?\s+", sql, re.IGNORECASE)
    if head:
        return f"with{head.group(1) or ''} " + ",\n".join(ctes) + ",\n" + sql[head.end():]
    return "with " + ",\n".join(ctes) + "\n" + sql


def check(name: str, sql: str | None = None):
    """Register ``build(tables)`` as a query, with the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"twice: {name}")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return register
