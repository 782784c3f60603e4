"""Projections, filters, joins, aggregates, order, sets and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_checks.base import check
from maillage import functions as fn
from maillage.operators import aggregates, filters, joins, ordering



# ---------------------------------------------------------------- projections and filters
@check("project", "select code as departement_code, nom as departement_nom from a_departement")
def _(t):
    return t.a_departement.select(F.col("code").alias("departement_code"), F.col("nom").alias("departement_nom"))


@check("filter_bool", "select id, is_mediateur from a_personne where is_mediateur")
def _(t):
    return t.a_personne.where("is_mediateur").select("id", "is_mediateur")


@check("filter_null", "select id, personne_id from a_poste where structure_id is null and date_rendu_poste is not null")
def _(t):
    return t.a_poste.where(F.col("structure_id").isNull() & F.col("date_rendu_poste").isNotNull()).select("id", "personne_id")


@check("filter_eq_literal", "select id from a_emploi where source = 'idposte'")
def _(t):
    return t.a_emploi.where(F.col("source") == "idposte").select("id")


@check("filter_in", """
    select id from a_emploi
    where source in ('idposte', 'coop') and personne_id in (select id from a_personne where is_coordinateur)""")
def _(t):
    coordinators = t.a_personne.where("is_coordinateur").select(F.col("id").alias("personne_id"))
    return t.a_emploi.where(F.col("source").isin("idposte", "coop")).join(coordinators, "personne_id", "left_semi").select("id")


@check("filter_null_safe_eq", """
    select o.id from a_structure o join a_structure_mapping m on m.id = o.id join a_structure w on w.id = m.root_id
    where o.siret is not distinct from w.siret and o.source is not distinct from w.source""")
def _(t):
    winner = t.a_structure.select(F.col("id").alias("root_id"), F.col("siret").alias("ws"), F.col("source").alias("wo"))
    joined = t.a_structure.join(t.a_structure_mapping, "id").join(winner, "root_id")
    return joined.where(F.col("siret").eqNullSafe(F.col("ws")) & F.col("source").eqNullSafe(F.col("wo"))).select("id")


@check("filter_sentinel_eq", """
    select c.id from a_coordination c join a_contrat k on k.id = c.id
    where coalesce(c.suppression, date '1234-01-02') = coalesce(k.date_debut, date '1234-01-02')
       or coalesce(c.suppression, date '1234-01-02') = coalesce(k.date_rupture, date '1234-01-02')""")
def _(t):
    joined = t.a_coordination.join(t.a_contrat.select("id", "date_debut", "date_rupture"), "id")
    close = F.col("suppression")
    return joined.where(
        filters.same_instant(close, F.col("date_debut")) | filters.same_instant(close, F.col("date_rupture"))
    ).select("id")


@check("filter_neq", """
    select p.id from a_poste p
    where exists (select 1 from a_poste x where x.poste_conum_id = p.poste_conum_id and x.structure_id = p.structure_id
                  and x.date_attribution = p.date_attribution and x.id <> p.id)""")
def _(t):
    # "Another row with the same key" is a count of the key, not a comparison of rows with each other.
    key = ["poste_conum_id", "structure_id", "date_attribution"]
    repeated = t.a_poste.dropna(subset=key).groupBy(*key).agg(F.count_distinct("id").alias("n")).where("n > 1")
    return joins.join_unique(t.a_poste, repeated, key, "left_semi").select("id")


@check("filter_regex", "select id, siret from a_structure where regexp_matches(siret, '^[0-9]{14}$') and regexp_matches(siret, '7$')")
def _(t):
    return t.a_structure.where(F.col("siret").rlike("^[0-9]{14}$") & F.col("siret").rlike("7$")).select("id", "siret")


@check("filter_or_null_bool", "select id from a_personne where is_mediateur = false or is_mediateur is null")
def _(t):
    return t.a_personne.where(filters.false_or_null(F.col("is_mediateur"))).select("id")


@check("soft_delete_filter", "select id from a_coordination where suppression is null")
def _(t):
    return filters.soft_delete_filter(t.a_coordination, "suppression").select("id")


@check("visible_only", "select id from a_personne where is_coordinateur is distinct from false")
def _(t):
    return filters.visible_only(t.a_personne.withColumnRenamed("is_coordinateur", "is_visible")).select("id")


@check("visible_on_map", "select id from a_personne where is_mediateur is not distinct from true")
def _(t):
    flagged = t.a_personne.withColumnRenamed("is_mediateur", "visible_pour_cartographie_nationale")
    return filters.visible_on_map(flagged).select("id")


@check("active_links", "select id, personne_id from a_emploi where est_active")
def _(t):
    return filters.active_links(t.a_emploi).select("id", "personne_id")


@check("projection_rename_bool", "select id, typologie = 'coordo' as est_coordinateur from a_poste")
def _(t):
    return t.a_poste.select("id", (F.col("typologie") == "coordo").alias("est_coordinateur"))


@check("scope_filter", "select etat, count(*) as nb from a_poste where structure_id = 3 group by etat")
def _(t):
    return filters.scope_filter(t.a_poste, "structure", 3).groupBy("etat").agg(F.count("*").alias("nb"))


# ---------------------------------------------------------------- joins
@check("join_inner", """
    select e.id, s.denomination_sirene from a_emploi e join a_structure_administrative s on s.id = e.structure_administrative_id""")
def _(t):
    s = t.a_structure_administrative.select(F.col("id").alias("structure_administrative_id"), "denomination_sirene")
    return t.a_emploi.join(s, "structure_administrative_id").select("id", "denomination_sirene")


@check("join_inner_multikey", """
    select p.id as poste_id, c.id as contrat_id from a_poste p
    join a_contrat c on c.personne_id = p.personne_id and c.structure_id = p.structure_id""")
def _(t):
    c = t.a_contrat.select("personne_id", "structure_id", F.col("id").alias("contrat_id"))
    return t.a_poste.join(c, ["personne_id", "structure_id"]).select(F.col("id").alias("poste_id"), "contrat_id")


@check("join_left_filtered", """
    select p.id as poste_id, c.id as contrat_id from a_poste p
    left join a_contrat c on c.personne_id = p.personne_id and c.structure_id = p.structure_id and c.date_rupture is null""")
def _(t):
    unbroken = t.a_contrat.where("date_rupture is null").select("personne_id", "structure_id", F.col("id").alias("contrat_id"))
    return t.a_poste.join(unbroken, ["personne_id", "structure_id"], "left").select(F.col("id").alias("poste_id"), "contrat_id")


@check("join_semi", """
    select id from a_personne p where exists (select 1 from a_emploi e where e.personne_id = p.id and e.est_active)""")
def _(t):
    active = t.a_emploi.where("est_active").select(F.col("personne_id").alias("id")).distinct()
    return t.a_personne.join(active, "id", "left_semi").select("id")


@check("join_anti", """
    select id from a_personne p where not exists (select 1 from a_emploi e where e.personne_id = p.id and e.source = 'min')""")
def _(t):
    other = t.a_emploi.where("source = 'min'").select(F.col("personne_id").alias("id")).distinct()
    return t.a_personne.join(other, "id", "left_anti").select("id")


@check("join_existence_flag", """
    select p.id,
      exists (select 1 from a_emploi e where e.personne_id = p.id and e.source = 'aidants-connect') as a_ac,
      exists (select 1 from a_emploi e where e.personne_id = p.id and e.est_active) as a_emploi_actif
    from a_personne p""")
def _(t):
    links = t.a_emploi.withColumnRenamed("personne_id", "pid").withColumnRenamed("id", "link_id")
    flags = {"a_ac": F.col("source") == "aidants-connect", "a_emploi_actif": F.col("est_active")}
    out = joins.existence_flags(t.a_personne.select(F.col("id").alias("pid")), links, "pid", flags)
    return out.withColumnRenamed("pid", "id")


@check("scalar_top1", """
    select p.id, (select e.structure_administrative_id from a_emploi e where e.personne_id = p.id and e.est_active
                  order by e.structure_administrative_id limit 1) as structure_id
    from a_personne p""")
def _(t):
    smallest = t.a_emploi.where("est_active").groupBy(F.col("personne_id").alias("id")).agg(
        F.min("structure_administrative_id").alias("structure_id")
    )
    return t.a_personne.select("id").join(smallest, "id", "left")


@check("join_left_chain", """
    select c.code_insee, d.code as departement, r.nom as region
    from a_commune c left join a_departement d on d.id = c.departement_id left join a_region r on r.id = d.region_id""")
def _(t):
    d = t.a_departement.select(F.col("id").alias("departement_id"), "region_id", F.col("code").alias("departement"))
    r = t.a_region.select(F.col("id").alias("region_id"), F.col("nom").alias("region"))
    return t.a_commune.join(d, "departement_id", "left").join(r, "region_id", "left").select("code_insee", "departement", "region")


@check("join_left_multi", """
    select p.id, k.nb as nb_contrats, e.nb as nb_emplois, f.nb as nb_formations
    from a_personne p
    left join (select personne_id, count(*) as nb from a_contrat group by 1) k on k.personne_id = p.id
    left join (select personne_id, count(*) as nb from a_emploi group by 1) e on e.personne_id = p.id
    left join (select personne_id, count(*) as nb from a_formation group by 1) f on f.personne_id = p.id""")
def _(t):
    def counted(df, name):
        return df.groupBy(F.col("personne_id").alias("id")).agg(F.count("*").alias(name))

    out = t.a_personne.select("id")
    for df, name in ((t.a_contrat, "nb_contrats"), (t.a_emploi, "nb_emplois"), (t.a_formation, "nb_formations")):
        out = out.join(counted(df, name), "id", "left")
    return out


@check("join_self_null_safe", """
    select distinct w.id from a_structure w join a_structure_mapping m on m.root_id = w.id join a_structure l on l.id = m.id
    where l.siret is not distinct from w.siret and l.denomination_sirene is not distinct from w.denomination_sirene""")
def _(t):
    loser = t.a_structure.join(t.a_structure_mapping, "id").select(F.col("root_id").alias("id"), "siret", "denomination_sirene")
    flagged = joins.flag_matches(t.a_structure, loser, ["id", "siret", "denomination_sirene"], "hit")
    return flagged.where("hit").select("id")


@check("join_self_active_closed", """
    select c.id as closed_id, min(a.id) as active_id
    from a_links c join a_links a on a.structure_id = c.structure_id and a.personne_id = c.personne_id and a.type = c.type
    where c.suppression is not null and a.suppression is null group by c.id""")
def _(t):
    who = ["structure_id", "personne_id", "type"]
    active = t.a_links.where("suppression is null").groupBy(*who).agg(F.min("id").alias("active_id"))
    return joins.join_unique(t.a_links.where("suppression is not null"), active, who, "inner").select(F.col("id").alias("closed_id"), "active_id")


@check("delete_using", """
    select e.id from a_emploi e
    where not exists (select 1 from a_contrat c where c.personne_id = e.personne_id and c.structure_id = e.structure_administrative_id)""")
def _(t):
    doomed = t.a_contrat.select("personne_id", F.col("structure_id").alias("structure_administrative_id"))
    return joins.delete_using(t.a_emploi, doomed, ["personne_id", "structure_administrative_id"]).select("id")


@check("update_from", """
    select p.id, case when c.id is not null then c.date_fin else p.date_attribution end as date_attribution
    from a_poste p left join a_contrat c on c.id = p.id and c.date_rupture is null""")
def _(t):
    changes = t.a_contrat.where("date_rupture is null").select("id", F.col("date_fin").alias("date_attribution"))
    return joins.update_from(t.a_poste.select("id", "date_attribution"), changes, ["id"])


@check("join_bridge", """
    select p.id, s.denomination_sirene from a_personne p join a_emploi e on e.personne_id = p.id
    join a_structure_administrative s on s.id = e.structure_administrative_id""")
def _(t):
    people = t.a_personne.select(F.col("id").alias("personne_id"))
    bridge = t.a_emploi.select("personne_id", "structure_administrative_id")
    entities = t.a_structure_administrative.select(F.col("id").alias("structure_administrative_id"), "denomination_sirene")
    out = joins.join_bridge(people, bridge, entities, "personne_id", "structure_administrative_id")
    return out.select(F.col("personne_id").alias("id"), "denomination_sirene")


@check("join_lookup", """
    select f.id, d.nom as departement_nom from a_feuille f left join a_departement d on d.code = f.gouvernance_departement_code""")
def _(t):
    return joins.join_lookup(t.a_feuille, t.a_departement, "gouvernance_departement_code", "code", "nom", "departement_nom").select(
        "id", "departement_nom"
    )


@check("join_insee_history", """
    with recursive step as (select distinct code_insee_ancien as a, code_insee_nouveau as b from a_insee_historique where code_insee_ancien <> code_insee_nouveau),
    walk as (select a, b from step union select w.a, s.b from walk w join step s on s.a = w.b),
    ends as (select a, b from walk w where not exists (select 1 from step s where s.a = w.b)),
    width as (select a, count(*) as nb from ends group by a)
    select c.code_insee, coalesce(e.b, c.code_insee) as code_insee_actuel, coalesce(x.nb, 1) as nb_codes_actuels
    from a_commune c left join ends e on e.a = c.code_insee left join width x on x.a = c.code_insee""")
def _(t):
    return joins.join_insee_history(t.a_commune.select("code_insee"), t.a_insee_historique)


@check("join_postal", """
    select a.id, count(*) as nb_communes from a_adresse a join a_commune c
    on lpad(cast(c.departement_id as string), 5, '3') = a.code_postal group by a.id""")
def _(t):
    # Candidates per postal code are counted before the addresses meet them.
    candidates = t.a_commune.groupBy(F.lpad(F.col("departement_id").cast("string"), 5, "3").alias("code_postal")).agg(
        F.count("*").alias("nb_communes")
    )
    return joins.join_unique(t.a_adresse, candidates, ["code_postal"], "inner").select("id", "nb_communes")


@check("join_legacy_mapping", """
    select s.id, coalesce(d.id, x.id) as structure_administrative_id
    from (select s_suppkey + 100000 as id, lpad(cast(cast(floor(s_suppkey / 2) as bigint) as string), 14, '1') as siret from supplier) s
    left join a_structure_administrative d on d.old_main_structure_id = s.id
    left join (select siret, min(id) as id from a_structure_administrative group by siret) x on x.siret = s.siret""")
def _(t):
    legacy = t.supplier.select(
        (F.col("s_suppkey") + 100000).alias("id"),
        F.lpad(F.floor(F.col("s_suppkey") / 2).cast("string"), 14, "1").alias("siret"),
    )
    return joins.join_legacy_mapping(legacy, t.a_structure_administrative).select("id", "structure_administrative_id")


@check("join_ci", "select p.id from a_personne p join a_personne q on lower(p.nom) = lower(upper(q.nom))")
def _(t):
    shouted = t.a_personne.select(F.upper("nom").alias("nom_b"))
    return joins.join_ci(t.a_personne, shouted, "nom", "nom_b").select("id")


# ---------------------------------------------------------------- aggregates
@check("agg_count", "select source, count(*) as nb from a_emploi group by source")
def _(t):
    return t.a_emploi.groupBy("source").agg(F.count("*").alias("nb"))


@check("agg_count_distinct", "select personne_id, count(distinct structure_id) as nb from a_contrat group by personne_id")
def _(t):
    return t.a_contrat.groupBy("personne_id").agg(F.count_distinct("structure_id").alias("nb"))


@check("agg_sum", "select cast(sum(montant_subvention_v1) as bigint) as total_v1 from a_subvention")
def _(t):
    return t.a_subvention.agg(F.sum("montant_subvention_v1").alias("total_v1"))


@check("agg_max", """
    select structure_id, personne_id, type, max(suppression) as dernier from a_links
    where suppression is not null group by 1, 2, 3""")
def _(t):
    return t.a_links.where("suppression is not null").groupBy("structure_id", "personne_id", "type").agg(
        F.max("suppression").alias("dernier")
    )


@check("agg_min", "select personne_id, min(structure_administrative_id) as premiere from a_emploi where est_active group by 1")
def _(t):
    return t.a_emploi.where("est_active").groupBy("personne_id").agg(F.min("structure_administrative_id").alias("premiere"))


@check("agg_bool_or", """
    select personne_id, bool_or(source = 'idposte') as cn, bool_or(source = 'coop') as coop from a_emploi where est_active group by 1""")
def _(t):
    return t.a_emploi.where("est_active").groupBy("personne_id").agg(
        F.bool_or(F.col("source") == "idposte").alias("cn"), F.bool_or(F.col("source") == "coop").alias("coop")
    )


@check("agg_group_expr", """
    select coalesce(structure_id, -1) as structure_id, type, count(*) as nb from a_links group by coalesce(structure_id, -1), type""")
def _(t):
    return t.a_links.groupBy(F.coalesce("structure_id", F.lit(-1)).alias("structure_id"), "type").agg(F.count("*").alias("nb"))


@check("agg_having", """
    select structure_coop_id, mediateur_coop_id, type, count(*) as nb from a_links group by 1, 2, 3 having count(*) > 1""")
def _(t):
    return t.a_links.groupBy("structure_coop_id", "mediateur_coop_id", "type").agg(F.count("*").alias("nb")).where("nb > 1")


TAIL = """
    select type, unnest(ids[2:]) as id from (
      select structure_coop_id, mediateur_coop_id, type, suppression, array_agg(id order by (structure_id is null), id) as ids
      from a_links where structure_coop_id is not null
      group by structure_coop_id, mediateur_coop_id, type, suppression having count(*) > 1) g"""


def _tail(t):
    """Ids after the first of each key, without gathering any group."""
    key = ["structure_coop_id", "mediateur_coop_id", "type", "suppression"]
    rows = t.a_links.where("structure_coop_id is not null")
    first = rows.groupBy(*key).agg(F.min(F.struct(F.col("structure_id").isNull().alias("o"), F.col("id").alias("first_id"))).alias("f"))
    joined = joins.null_safe_join(rows, first, key, "inner")
    return joined.where(F.col("id") != F.col("f.first_id")).select("type", "id")


@check("agg_array_ordered", TAIL)
def _(t):
    return _tail(t)


@check("array_slice_tail", """
    select type, list_aggregate(list_sort(ids)[2:], 'string_agg', ',') as reste from (
      select type, list(distinct personne_id % 9) as ids from a_links group by type) g""")
def _(t):
    # The arrays hold at most nine distinct values.
    ids = t.a_links.groupBy("type").agg(F.array_sort(F.collect_set(F.col("personne_id") % 9)).alias("ids"))
    return ids.select("type", F.array_join(fn.array_slice_tail(F.col("ids")).cast("array<string>"), ",").alias("reste"))


@check("agg_distinct_on", """
    select distinct on (personne_id) personne_id, id, date_fin from a_contrat
    order by personne_id, date_fin desc nulls last, id""")
def _(t):
    order = [F.col("date_fin").desc_nulls_last(), F.col("id").asc()]
    return ordering.first_row_per_key(t.a_contrat, ["personne_id"], order).select("personne_id", "id", "date_fin")


@check("rollup_territory", """
    select r.code as region, d.code as departement, c.code_insee as commune, cast(grouping(r.code, d.code, c.code_insee) as int) as niveau,
      cast(count(*) as bigint) as nb, cast(sum(c.population) as bigint) as population
    from a_commune c left join a_departement d on d.id = c.departement_id left join a_region r on r.id = d.region_id
    group by grouping sets ((r.code, d.code, c.code_insee), (r.code, d.code), (r.code), ())""")
def _(t):
    d = t.a_departement.select(F.col("id").alias("departement_id"), "region_id", F.col("code").alias("departement"))
    r = t.a_region.select(F.col("id").alias("region_id"), F.col("code").alias("region"))
    flat = t.a_commune.join(d, "departement_id", "left").join(r, "region_id", "left").withColumnRenamed("code_insee", "commune")
    return aggregates.rollup_territory(flat, ["region", "departement", "commune"], {"population": F.col("population")})


@check("explode_count", """
    select thematique, count(*) as nb from (select unnest([type, concat('t', cast(sujet as string))]) as thematique from a_activites) x group by 1""")
def _(t):
    topics = F.array("type", F.concat(F.lit("t"), F.col("sujet").cast("string")))
    return aggregates.explode_count(t.a_activites, topics, alias="thematique")


# ---------------------------------------------------------------- order, top-k
@check("first_row_per_key", """
    select distinct on (personne_id, type) personne_id, type, id from a_links
    order by personne_id, type, (suppression is null) desc, suppression desc nulls last, id""")
def _(t):
    order = [F.col("suppression").isNull().desc(), F.col("suppression").desc_nulls_last(), F.col("id").asc()]
    return ordering.first_row_per_key(t.a_links, ["personne_id", "type"], order).select("personne_id", "type", "id")


@check("latest_contract", """
    select personne_id, structure_id, date_fin, id from (
      select *, row_number() over (partition by personne_id, structure_id order by date_fin desc nulls last, id) as r from a_contrat) x where r = 1""")
def _(t):
    order = [F.col("date_fin").desc_nulls_last(), F.col("id").asc()]
    return ordering.first_row_per_key(t.a_contrat, ["personne_id", "structure_id"], order).select(
        "personne_id", "structure_id", "date_fin", "id"
    )


@check("keep_first_neutralise_rest", """
    select id, case when r > 1 then null else structure_coop_id end as structure_coop_id from (
      select *, row_number() over (partition by structure_coop_id, mediateur_coop_id, type, suppression order by (structure_id is null), id) as r
      from a_links) x""")
def _(t):
    key = ["structure_coop_id", "mediateur_coop_id", "type", "suppression"]
    out = ordering.neutralise_rest(t.a_links, key, [F.col("structure_id").isNull()], "id", ["structure_coop_id"])
    return out.select("id", "structure_coop_id")


@check("top_k", "select personne_id, count(*) as nb from a_emploi group by 1 order by nb desc, personne_id limit 20")
def _(t):
    counted = t.a_emploi.groupBy("personne_id").agg(F.count("*").alias("nb"))
    return ordering.top_k(counted, "nb", "personne_id", 20)


@check("sort_nulls_last", "select id, date_fin from a_contrat")
def _(t):
    return t.a_contrat.select("id", "date_fin").orderBy(F.col("date_fin").desc_nulls_last(), "id")


@check("sort_bool_expr", "select id, structure_id from a_poste")
def _(t):
    return t.a_poste.select("id", "structure_id").orderBy(F.col("structure_id").isNull().desc(), "id")


@check("limit_exploratory", "select id, etat from a_poste order by id limit 100")
def _(t):
    return t.a_poste.select("id", "etat").orderBy("id").limit(100)


# ---------------------------------------------------------------- sets and arrays
@check("set_union_distinct", "select personne_id from a_contrat union select personne_id from a_formation")
def _(t):
    return t.a_contrat.select("personne_id").union(t.a_formation.select("personne_id")).distinct()


@check("set_difference", "select code_insee from a_commune except select code_insee from a_ifn_commune")
def _(t):
    return t.a_commune.select("code_insee").subtract(t.a_ifn_commune.select("code_insee"))


@check("select_distinct", "select distinct label, parcours from a_formation")
def _(t):
    return t.a_formation.select("label", "parcours").distinct()


def _lists(t):
    w = t.a_structure.select(F.col("id").alias("root_id"), F.split("typologies_texte", r"\|").alias("w"))
    both = t.a_structure.join(t.a_structure_mapping, "id").select("id", "root_id", F.split("typologies_texte", r"\|").alias("l"))
    return both.join(w, "root_id")


PAIR_LISTS = """
    select m.id, string_split(w.typologies_texte, '|') as w, string_split(l.typologies_texte, '|') as l
    from a_structure_mapping m join a_structure w on w.id = m.root_id join a_structure l on l.id = m.id"""


@check("array_union_clean", f"""
    select id, array_to_string(list_sort(case when w is not null and l is not null
      then list_distinct(list_filter(list_concat(w, l), lambda e: e is not null and e <> '')) else coalesce(w, l) end), ',') as liste
    from ({PAIR_LISTS}) p""")
def _(t):
    union = F.array_sort(fn.array_union_clean(F.col("w"), F.col("l")))
    return _lists(t).select("id", F.array_join(union, ",").alias("liste"))


@check("array_remainder", f"""
    select id, array_to_string(list_sort(list_distinct(list_filter(w, lambda e: not list_contains(l, e)))), ',') as reste
    from ({PAIR_LISTS}) p where w is not null and l is not null""")
def _(t):
    both = _lists(t).where("w is not null and l is not null")
    return both.select("id", F.array_join(F.array_sort(fn.array_remainder(F.col("w"), F.col("l"))), ",").alias("reste"))


@check("array_concat_unnest", f"""
    select e as element, count(*) as nb from (select unnest(list_concat(w, l)) as e from ({PAIR_LISTS}) p where w is not null and l is not null) x group by e""")
def _(t):
    return _lists(t).select(F.explode(F.concat("w", "l")).alias("element")).groupBy("element").agg(F.count("*").alias("nb"))


# ---------------------------------------------------------------- scalar expressions
@check("case_when", """
    select id, case when is_mediateur then 'mediateur' when is_coordinateur then 'coordinateur' else 'autre' end as role from a_personne""")
def _(t):
    role = F.when(F.col("is_mediateur"), "mediateur").when(F.col("is_coordinateur"), "coordinateur").otherwise("autre")
    return t.a_personne.select("id", role.alias("role"))


@check("coalesce_money", """
    select poste_id, coalesce(montant_subvention_v2, 0) - coalesce(montant_bonification_v2, 0) as net_v2,
      coalesce(montant_bonification_v2, 0) > 0 as bonifie from a_subvention""")
def _(t):
    v2, bonus = F.col("montant_subvention_v2"), F.col("montant_bonification_v2")
    return t.a_subvention.select("poste_id", fn.net_v2(v2, bonus).alias("net_v2"), (fn.zero_if_null(bonus) > 0).alias("bonifie"))


@check("nullif_blank", r"""
    select s.id, nullif(s.source, '') as source, case when regexp_replace(p.contact, '\s', '', 'g') = '{}' then null else p.contact end as contact
    from a_structure s join a_personne p on p.id = s.id""")
def _(t):
    people = t.a_personne.select("id", fn.empty_json_to_null(F.col("contact")).alias("contact"))
    return t.a_structure.join(people, "id").select("id", F.nullif(F.col("source"), F.lit("")).alias("source"), "contact")


@check("greatest_nulls", """
    select poste_id, greatest(date_fin_convention_dgcl, date_fin_convention_ditp, date_fin_convention_dge) as fin from a_subvention""")
def _(t):
    return t.a_subvention.select(
        "poste_id", F.greatest("date_fin_convention_dgcl", "date_fin_convention_ditp", "date_fin_convention_dge").alias("fin")
    )


@check("greatest_floor", """
    select w.id, greatest(coalesce(w.last_sirene_enrich_at, date '1900-01-01'), coalesce(l.last_sirene_enrich_at, date '1900-01-01')) as vu
    from a_structure_mapping m join a_structure w on w.id = m.root_id join a_structure l on l.id = m.id""")
def _(t):
    loser = t.a_structure.join(t.a_structure_mapping, "id").select(F.col("root_id").alias("id"), F.col("last_sirene_enrich_at").alias("l"))
    joined = t.a_structure.select("id", "last_sirene_enrich_at").join(loser, "id")
    return joined.select("id", fn.greatest_floor(F.col("last_sirene_enrich_at"), F.col("l")).alias("vu"))


@check("departement_of_insee", """
    select code_insee, case when code_insee like '97%' or code_insee like '98%' then substr(code_insee, 1, 3) else substr(code_insee, 1, 2) end as departement
    from a_commune""")
def _(t):
    return t.a_commune.select("code_insee", fn.departement_of_insee(F.col("code_insee")).alias("departement"))


@check("periode_of_date", "select cast(date_trunc('month', date) as date) as periode, count(*) as nb from a_activites group by 1")
def _(t):
    return t.a_activites.groupBy(fn.periode_of_date(F.col("date")).alias("periode")).agg(F.count("*").alias("nb"))


@check("casts", """
    select id, cast(date_debut as timestamp) as debut, cast(id as string) as texte, cast(cast(created_at as date) as string) as jour
    from (select c.id, c.date_debut, p.created_at from a_contrat c join a_poste p on p.id = c.id) x""")
def _(t):
    joined = t.a_contrat.join(t.a_poste.select("id", "created_at"), "id")
    return joined.select(
        "id", F.col("date_debut").cast("timestamp_ntz").alias("debut"), F.col("id").cast("string").alias("texte"),
        F.col("created_at").cast("date").cast("string").alias("jour"),
    )


@check("string_concat", "select id, prenom || ' ' || nom as nom_complet, lower(nom) as nom_bas from a_personne")
def _(t):
    return t.a_personne.select("id", fn.nom_complet(F.col("prenom"), F.col("nom")).alias("nom_complet"), F.lower("nom").alias("nom_bas"))


@check("json_access", """
    select id, cast(json_extract(beneficiaires, '$.total') as bigint) as total, cast(json_extract(beneficiaires, '$.genres.f') as bigint) as femmes
    from a_activites""")
def _(t):
    def field(path):
        return F.get_json_object("beneficiaires", path).cast("bigint")

    return t.a_activites.select("id", field("$.total").alias("total"), field("$.genres.f").alias("femmes"))


@check("label_enveloppes", """
    select poste_id, case (montant_subvention_v1 is not null)::int * 2 + (montant_subvention_v2 is not null)::int
      when 3 then 'V1, V2' when 2 then 'V1' when 1 then 'V2' end as enveloppes from a_subvention""")
def _(t):
    label = fn.label_enveloppes(F.col("montant_subvention_v1"), F.col("montant_subvention_v2"))
    return t.a_subvention.select("poste_id", label.alias("enveloppes"))


@check("normalise_activity_type", """
    select case type when 'individuel' then 'Individuel' when 'demarche_administrative' then 'DemarcheAdministrative' else 'Atelier' end as type_label,
      count(*) as nb from a_activites group by 1""")
def _(t):
    label = fn.normalise_activity_type(F.col("type"), {"collectif": "Atelier"})
    return t.a_activites.groupBy(label.alias("type_label")).agg(F.count("*").alias("nb"))


@check("now_stamp", "select id, timestamp '2026-01-01 00:00:00' as updated_at from a_poste where etat = 'vacant'")
def _(t):
    return t.a_poste.where("etat = 'vacant'").select("id", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"))
