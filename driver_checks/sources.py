"""Landing, reading, cleaning, keys, profiles, refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_checks.base import check
from maillage.plans.territory import coll_terr
from maillage.session import scratch_path
from maillage.sources import landing, profiling, refresh, tables


@check("read_table", "select id, nom from a_departement")
def _(t):
    root = scratch_path(t.spark, "tables")
    t.a_departement.write.parquet(f"{root}/min/departement")
    return tables.read_table(t.spark, root, "min.departement").select("id", "nom")


@check("write_table", """
    select date_trunc('month', date)::date as periode, type, count(*) as nb, cast(sum(duree) as bigint) as minutes from a_activites group by 1, 2""")
def _(t):
    root = scratch_path(t.spark, "activities")
    tables.write_table(t.a_activites, root, "main.activites_coop", ["periode"])
    written = tables.read_table(t.spark, root, "main.activites_coop")
    return written.groupBy("periode", "type").agg(F.count("*").alias("nb"), F.sum("duree").alias("minutes"))


@check("land_raw", "select * from customer")
def _(t):
    return t.spark.read.parquet(landing.land_raw(t.customer, "crm", "clients", scratch_path(t.spark, "land")))


@check("read_csv_source", "select id, personne_id, source, est_active from a_emploi")
def _(t):
    path = scratch_path(t.spark, "csv")
    t.a_emploi.select("id", "personne_id", "source", "est_active").write.option("header", True).csv(path)
    return landing.read_csv_source(t.spark, path, "id bigint, personne_id bigint, source string, est_active boolean")


@check("read_json_source", "select event_id as id, event_type as type, user_id as personne_id from events")
def _(t):
    path = scratch_path(t.spark, "json")
    payload = t.events.select(
        F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("personne_id")).alias("attributes")
    )
    payload.write.json(path)
    return landing.read_json_source(t.spark, path, "id bigint, attributes struct<type string, personne_id bigint>")


@check("ingest_clean", """
    select id, nom as denomination, nullif(trim(source), '') as origine from a_structure""")
def _(t):
    rows = t.a_structure.select("id", "nom", F.concat(F.lit("  "), "source").alias("source"))
    return landing.ingest_clean(rows, {"nom": "denomination", "source": "origine"})


@check("ingest_surrogate_key", """
    select id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) as uuid
    from (select id, sha256('4:coop|' || length(cast(id as varchar)) || ':' || cast(id as varchar) || '|'
            || coalesce(length(coop_id) || ':' || coop_id, '-')) as h from a_personne) x""")
def _(t):
    return landing.ingest_surrogate_key(t.a_personne, "coop", ["id", "coop_id"]).select("id", "uuid")


@check("refresh_table", """
    select c.code_insee as commune_code, d.code as departement_code, r.code as region_code
    from a_commune c left join a_departement d on d.id = c.departement_id left join a_region r on r.id = d.region_id""")
def _(t):
    path = scratch_path(t.spark, "coll_terr")

    def build():
        return coll_terr(t.a_commune, t.a_departement, t.a_region)

    refresh.refresh_table(t.spark, path, build)
    # The second refresh replaces the first.
    return refresh.refresh_table(t.spark, path, build).select("commune_code", "departement_code", "region_code")


def _profile_sql(columns):
    return " union all ".join(
        f"select 'main.subvention' as table_name, '{c}' as column_name, count(*) as nb, count(*) - count({c}) as nb_null, "
        f"cast(min({c}) as varchar) as min_value, cast(max({c}) as varchar) as max_value from a_subvention" for c in columns
    )


GRANT_COLUMNS = ("poste_id", "montant_subvention_v1", "montant_subvention_v2", "date_fin_convention_dge")


@check("profile_columns", _profile_sql(GRANT_COLUMNS))
def _(t):
    # The approximate number of distinct values has no exact counterpart and is left out here.
    return profiling.profile_columns(t.a_subvention.select(*GRANT_COLUMNS), "main.subvention").drop("approx_distinct")


@check("profile_once", _profile_sql(GRANT_COLUMNS[2:]))
def _(t):
    rows = t.a_subvention.select(*GRANT_COLUMNS)
    done = profiling.profile_columns(rows.select(*GRANT_COLUMNS[:2]), "main.subvention").select("table_name", "column_name")
    return profiling.profile_columns(rows, "main.subvention", done).drop("approx_distinct")


@check("catalog_columns", """
    select 'main.subvention' as table_name, c.position, c.column_name, f.nb - f.nb_rempli as nb_null
    from (values (1, 'poste_id'), (2, 'montant_subvention_v1'), (3, 'montant_subvention_v2'), (4, 'date_fin_convention_dge')) c(position, column_name),
      lateral (select count(*) as nb, count(case c.column_name when 'poste_id' then poste_id when 'montant_subvention_v1' then montant_subvention_v1
        when 'montant_subvention_v2' then montant_subvention_v2 else epoch(date_fin_convention_dge) end) as nb_rempli from a_subvention) f""")
def _(t):
    rows = t.a_subvention.select(*GRANT_COLUMNS)
    described = tables.catalog_columns(t.spark, {"main.subvention": rows}).select("table_name", "position", "column_name")
    nulls = profiling.profile_columns(rows, "main.subvention").select("column_name", "nb_null")
    return described.join(nulls, "column_name")
