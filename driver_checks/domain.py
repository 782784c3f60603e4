"""Views and reports of the data model."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_checks.base import check
from maillage.functions import departement_of_insee
from maillage.operators import aggregates
from maillage.plans import activity, grants, people, privacy, territory

# ---------------------------------------------------------------- people
# One aggregate of the active employments decides every flag.
ENRICHED = """
    with employed as (
      select personne_id, count_if(source = 'aidants-connect') > 0 as labelled, count_if(source = 'idposte') > 0 as funded,
        count_if(source in ('coop', 'idposte')) > 0 as mediating, min(structure_administrative_id) as employer
      from a_emploi where est_active group by personne_id
    ), judged as (
      select person.*, coalesce(is_mediateur, false) as mediator, coalesce(labelled, false) as labelled, coalesce(funded, false) as funded,
        case when coalesce(is_mediateur, false) then coalesce(mediating, false) else coalesce(labelled, false) end as at_work, employer
      from a_personne person left join employed on employed.personne_id = person.id
    )
    select * exclude (mediator, labelled, funded, at_work, employer), if(mediator, 'mediateur', 'aidant_numerique') as type_accompagnateur,
      labelled as labellisation_aidant_connect, mediator and at_work as est_actuellement_mediateur_en_poste,
      at_work and not mediator as est_actuellement_aidant_numerique_en_poste, funded as est_actuellement_conseiller_numerique,
      at_work and coalesce(is_coordinateur, false) as est_actuellement_coordo_actif, employer as structure_employeuse_id
    from judged"""
REDUCED = f"""
    select id, aidant_connect_id, cn_pg_id, coop_id, is_coordinateur, is_mediateur, nb_accompagnements_ac, profession_ac, type_accompagnateur,
      labellisation_aidant_connect, est_actuellement_mediateur_en_poste, est_actuellement_aidant_numerique_en_poste,
      est_actuellement_conseiller_numerique, est_actuellement_coordo_actif, structure_employeuse_id
    from ({ENRICHED}) e"""


def _reduced(t):
    return privacy.safe_view("llm.personne_enrichie", people.personne_enrichie(t.a_personne, t.a_emploi))


@check("mediateurs_par_structure", f"""
    select s.denomination_sirene, cast(count(*) as bigint) as nb_mediateurs
    from ({REDUCED}) p join a_structure_administrative s on s.id = p.structure_employeuse_id
    where p.est_actuellement_mediateur_en_poste
    group by s.denomination_sirene order by nb_mediateurs desc, s.denomination_sirene limit 20""")
def mediateurs_par_structure(t):
    structures = privacy.safe_view("llm.structure_administrative", t.a_structure_administrative)
    return people.mediateurs_par_structure(_reduced(t), structures)


@check("personne_enrichie", ENRICHED)
def _(t):
    return people.personne_enrichie(t.a_personne, t.a_emploi)


@check("llm_personne_enrichie", REDUCED)
def _(t):
    return _reduced(t)


@check("structures_par_departement", """
    select departement_code, count(*) as nb_structures from a_structure_administrative
    group by 1 order by nb_structures desc, departement_code limit 20""")
def _(t):
    return people.structures_par_departement(t.a_structure_administrative)


@check("coordination_active", """
    select coordinateur_id, count(distinct mediateur_id) as nb_mediateurs from a_coordination where suppression is null group by 1""")
def _(t):
    return people.coordination_active(t.a_coordination)


@check("formations_par_parcours", """
    select label, parcours, count(*) as nb_formations, count(distinct personne_id) as nb_personnes from a_formation group by 1, 2""")
def _(t):
    return people.formations_par_parcours(t.a_formation)


# ---------------------------------------------------------------- grants
# Positions in the order in which one of a pair is chosen, with the facts about the contracts of their person and structure.
RANKED = """
    with agreed as (
      select personne_id, structure_id, count(distinct id) filter (date_rupture is null) as running, max(date_fin) as last_end
      from a_contrat where personne_id is not null and structure_id is not null group by all
    )
    select position.*, coalesce(running, 0) as running, last_end, agreed.personne_id is not null as has_contract,
      row_number() over (partition by poste_conum_id, structure_id
        order by least(coalesce(running, 0), 1) desc, coalesce(date_attribution, date '0001-01-01') desc, created_at is null desc, created_at desc, id) as place
    from a_poste position left join agreed using (personne_id, structure_id)"""
PICKED = f"select * from ({RANKED}) ranked where place = 1"
# What each grant adds to the pair of its position, absent amounts as 0.
MONEY = """
    select poste_conum_id, structure_id,
      nullif(concat_ws(', ', if(montant_subvention_v1 is null, null, 'V1'), if(montant_subvention_v2 is null, null, 'V2')), '') as enveloppes,
      list_max([date_fin_convention_dge, date_fin_convention_dgcl, date_fin_convention_ditp]) as date_fin_convention,
      coalesce(montant_subvention_v1, 0) as first_grant, coalesce(montant_subvention_v2, 0) as second_grant, coalesce(montant_bonification_v2, 0) as bonus,
      coalesce(montant_versement_v1, 0) as first_paid,
      coalesce(list_sum([versement_1_v2, versement_2_v2, versement_3_v2]), 0)::bigint as second_paid
    from a_subvention funding join (select id as poste_id, poste_conum_id, structure_id from a_poste) place using (poste_id)"""
GRANTS = f"""
    select poste_conum_id, structure_id, enveloppes, date_fin_convention, bonus > 0 as is_territoire_prioritaire, first_grant as montant_subvention_v1,
      0::int as montant_bonification_v1, second_grant - bonus as montant_subvention_v2, bonus as montant_bonification_v2,
      first_grant + second_grant as montant_subvention_cumule
    from ({MONEY}) money"""
PAID = f"""
    select poste_conum_id, structure_id, first_paid + second_paid as montant_versement_cumule, first_paid as versement_cumule_v1, second_paid as versement_cumule_v2
    from ({MONEY}) money"""
# Per pair a list of its grants and one of its payments, every element of one beside every element of the other.
CROSSED = f"""
    select poste_conum_id, structure_id, granted, unnest(payments) as paid
    from (select poste_conum_id, structure_id, unnest(listed) as granted, listed as payments
          from (select poste_conum_id, structure_id, list(money) as listed from ({MONEY}) money group by all) pairs) granted"""
ADDED = f"""
    select poste_conum_id, structure_id, total as granted, total as paid
    from (select poste_conum_id, structure_id, struct_pack(
        enveloppes := nullif(concat_ws(', ', if(bool_or(contains(enveloppes, 'V1')), 'V1', null), if(bool_or(contains(enveloppes, 'V2')), 'V2', null)), ''),
        date_fin_convention := max(date_fin_convention), first_grant := sum(first_grant), second_grant := sum(second_grant), bonus := sum(bonus),
        first_paid := sum(first_paid), second_paid := sum(second_paid)) as total
      from ({MONEY}) money group by all) added"""


def _summary_sql(funded: str) -> str:
    def amount(value: str) -> str:
        return f"coalesce({value}, 0)::bigint"

    return f"""
    select poste_conum_id, id as poste_id, structure_id, personne_id, etat, typologie, typologie = 'coordo' as est_coordinateur, granted.enveloppes as enveloppes,
      granted.date_fin_convention as date_fin_convention, last_end as date_fin_contrat, {amount('granted.bonus')} > 0 as bonification,
      {amount('granted.first_grant + granted.second_grant')} as montant_subvention_cumule, {amount('paid.first_paid + paid.second_paid')} as montant_versement_cumule,
      {amount('granted.first_grant')} as subvention_v1, 0::int as bonification_v1, {amount('paid.first_paid')} as versement_cumule_v1,
      {amount('granted.second_grant - granted.bonus')} as subvention_v2, {amount('granted.bonus')} as bonification_v2,
      {amount('paid.second_paid')} as versement_cumule_v2, running as nb_contrats_en_cours
    from ({PICKED}) picked left join ({funded}) funded using (poste_conum_id, structure_id)"""


@check("poste_par_structure", f"select id, poste_conum_id, structure_id, personne_id, etat, typologie from ({PICKED}) p")
def _(t):
    return grants.poste_par_structure(t.a_poste, t.a_contrat)


@check("contrats_en_cours", f"select poste_conum_id, structure_id, running as nb_contrats_en_cours from ({PICKED}) p where running > 0")
def _(t):
    return grants.contrats_en_cours(t.a_poste, t.a_contrat)


@check("dernier_contrat", f"select poste_conum_id, structure_id, last_end as date_fin from ({PICKED}) p where has_contract")
def _(t):
    return grants.dernier_contrat(t.a_poste, t.a_contrat)


@check("subventions_par_enveloppe", GRANTS)
def _(t):
    return grants.subventions_par_enveloppe(t.a_subvention, t.a_poste)


@check("versements_cumules", PAID)
def _(t):
    return grants.versements_cumules(t.a_subvention, t.a_poste)


@check("postes_synthese", _summary_sql(CROSSED))
def _(t):
    return grants.postes_synthese(t.a_poste, t.a_contrat, t.a_subvention)


@check("postes_synthese_collapse", _summary_sql(ADDED))
def _(t):
    return grants.postes_synthese(t.a_poste, t.a_contrat, t.a_subvention, collapse=True)


@check("postes_synthese_totaux", f"""
    select count(*) as nb_lignes, sum(montant_subvention_cumule)::bigint as montant_subvention_cumule, sum(montant_versement_cumule)::bigint as montant_versement_cumule,
      sum(subvention_v1)::bigint as subvention_v1, sum(versement_cumule_v1)::bigint as versement_cumule_v1, sum(subvention_v2)::bigint as subvention_v2,
      sum(bonification_v2)::bigint as bonification_v2, sum(versement_cumule_v2)::bigint as versement_cumule_v2
    from ({_summary_sql(CROSSED)}) s""")
def _(t):
    totals = grants.postes_factorises(t.a_poste, t.a_contrat, t.a_subvention).totals()
    return totals.select(*[F.col(c).cast("long").alias(c) for c in totals.columns])


@check("fenetre_contrat", f"""
    select poste_id, structure_id, date_fin_convention, montant_subvention_cumule
    from ({_summary_sql(ADDED)}) s where date_fin_convention < date '1999-01-01'""")
def _(t):
    summary = grants.postes_synthese(t.a_poste, t.a_contrat, t.a_subvention, collapse=True)
    return grants.fenetre_contrat(summary, "1999-01-01").select(
        "poste_id", "structure_id", "date_fin_convention", "montant_subvention_cumule"
    )


@check("total_subvention_v2", "select cast(sum(montant_subvention_v2) as bigint) as total_v2 from a_subvention")
def _(t):
    return grants.total_subvention_v2(t.a_subvention)


@check("postes_par_etat", "select etat, count(*) as nb_postes from a_poste group by 1")
def _(t):
    return grants.postes_par_etat(t.a_poste)


@check("consommation_enveloppe", """
    select q.departement_code, q.enveloppe_id, q.nb_demandes, cast(q.demande as double) as montant_demande, e.montant as montant_enveloppe,
      c.plafond, cast(q.demande as double) / nullif(c.plafond, 0) as taux_plafond
    from (
      select f.gouvernance_departement_code as departement_code, d.enveloppe_financement_id as enveloppe_id, count(*) as nb_demandes,
        sum(cast(d.subvention_demandee as decimal(28,8))) as demande
      from a_demande d join a_action a on a.id = d.action_id join a_feuille f on f.id = a.feuille_de_route_id group by 1, 2) q
    join a_enveloppe e on e.id = q.enveloppe_id
    left join a_plafond c on c.departement_code = q.departement_code and c.enveloppe_id = q.enveloppe_id""")
def _(t):
    return grants.consommation_enveloppe(t.a_demande, t.a_action, t.a_feuille, t.a_enveloppe, t.a_plafond)


@check("cofinancement_par_action", """
    select a.id as action_id, a.budget_global, ifnull(c.nb, 0) as nb_cofinancements, ifnull(cast(c.total as double), 0.0) as cofinancement,
      ifnull(cast(c.total as double), 0.0) / nullif(a.budget_global, 0) as part_cofinancee
    from a_action a left join (
      select id_action, count(*) as nb, sum(cast(montant as decimal(28,8))) as total from a_cofinancement group by 1) c on c.id_action = a.id""")
def _(t):
    return grants.cofinancement_par_action(t.a_action, t.a_cofinancement)


# ---------------------------------------------------------------- territory
FLAT = """
    select r.code as region_code, r.nom as region_nom, d.code as departement_code, d.nom as departement_nom,
      c.code_insee as commune_code, c.nom as commune_nom
    from a_commune c left join a_departement d on d.id = c.departement_id left join a_region r on r.id = d.region_id"""


@check("coll_terr", FLAT)
def _(t):
    return territory.coll_terr(t.a_commune, t.a_departement, t.a_region)


@check("fragilite_territoire", """
    select c.departement_id, count(*) as nb_territoires, cast(sum(c.population) as bigint) as population,
      cast(sum(i.score * c.population) as double) / nullif(sum(c.population), 0) as score_moyen
    from a_commune c join a_ifn_commune i on i.code_insee = c.code_insee group by 1""")
def _(t):
    return territory.fragilite_territoire(t.a_commune, t.a_ifn_commune, "code_insee", ["departement_id"])


@check("structures_en_zone", """
    with z as (select code_insee, bool_or(type = 'FRR') as frr, bool_or(type = 'QPV') as qpv from a_zonage group by 1),
    s as (select a.lieu_code_insee as code_insee, coalesce(z.frr, false) as frr, coalesce(z.qpv, false) as qpv
          from a_activites a left join z on z.code_insee = a.lieu_code_insee)
    select 'FRR' as type, count(*) filter (where frr) as nb_sites, count(distinct code_insee) filter (where frr) as nb_communes,
      count(*) filter (where frr) / count(*) as part_sites, count(distinct code_insee) filter (where frr) / count(distinct code_insee) as part_communes from s
    union all
    select 'QPV', count(*) filter (where qpv), count(distinct code_insee) filter (where qpv),
      count(*) filter (where qpv) / count(*), count(distinct code_insee) filter (where qpv) / count(distinct code_insee) from s""")
def _(t):
    sites = t.a_activites.select(F.col("lieu_code_insee").alias("code_insee"))
    return territory.structures_en_zone(sites, t.a_zonage)


@check("comparaison_territoriale", """
    with l as (select d.region_id, d.code as departement_code, sum(c.population) as population
               from a_commune c join a_departement d on d.id = c.departement_id group by 1, 2)
    select region_id, departement_code, cast(population as bigint) as population,
      cast(sum(population) over (partition by region_id) as bigint) as population_region,
      cast(sum(population) over () as bigint) as population_nation
    from l""")
def _(t):
    d = t.a_departement.select(F.col("id").alias("departement_id"), "region_id", F.col("code").alias("departement_code"))
    flat = t.a_commune.join(d, "departement_id")
    return territory.comparaison_territoriale(flat, "region_id", "departement_code", {"population": F.col("population")})


# ---------------------------------------------------------------- activity
@check("activites_par_territoire_periode", """
    select case when lieu_code_insee like '97%' or lieu_code_insee like '98%' then substr(lieu_code_insee, 1, 3) else substr(lieu_code_insee, 1, 2) end as departement_code,
      cast(date_trunc('month', date) as date) as periode, count(*) as nb_activites, cast(sum(duree) as bigint) as minutes,
      cast(sum(accompagnements) as bigint) as accompagnements
    from a_activites group by 1, 2""")
def _(t):
    return activity.activites_par_territoire_periode(t.a_activites)


@check("activites_par_thematique", """
    select thematique, count(*) as nb_activites
    from (select unnest([type, concat('sujet ', cast(sujet as string))]) as thematique from a_activites) x group by 1""")
def _(t):
    topics = F.array("type", F.concat(F.lit("sujet "), F.col("sujet").cast("string")))
    return activity.activites_par_thematique(t.a_activites, topics)


BENEFICIARIES = """
    select 'total' as groupe, 'total' as cle, cast(sum(cast(json_extract(beneficiaires, '$.total') as bigint)) as bigint) as nb from a_activites
    union all
    select 'genres', k, cast(sum(cast(json_extract(beneficiaires, '$.genres.' || k) as bigint)) as bigint) from a_activites, (values ('f'), ('m')) v(k) group by k
    union all
    select 'statuts', k, cast(sum(cast(json_extract(beneficiaires, '$.statuts.' || k) as bigint)) as bigint) from a_activites, (values ('f'), ('o')) v(k) group by k"""


@check("beneficiaires_totaux", BENEFICIARIES)
def _(t):
    return activity.beneficiaires_totaux(t.a_activites)


@check("sum_json_counts", """
    select 'total' as groupe, 'total' as cle, cast(sum(accompagnements) as bigint) as nb from a_activites
    union all select 'genres', 'f', cast(sum(duree) as bigint) from a_activites
    union all select 'genres', 'm', cast(sum(accompagnements) as bigint) from a_activites""")
def _(t):
    return aggregates.sum_json_counts(t.a_activites, "beneficiaires", ["genres"])


@check("fragilite_par_departement_insee", """
    select case when i.code_insee like '97%' or i.code_insee like '98%' then substr(i.code_insee, 1, 3) else substr(i.code_insee, 1, 2) end as departement,
      count(*) as nb_territoires, cast(sum(c.population) as bigint) as population,
      cast(sum(i.score * c.population) as double) / nullif(sum(c.population), 0) as score_moyen
    from a_commune c join a_ifn_commune i on i.code_insee = c.code_insee group by 1""")
def _(t):
    communes = t.a_commune.withColumn("departement", departement_of_insee(F.col("code_insee")))
    return territory.fragilite_territoire(communes, t.a_ifn_commune, "code_insee", ["departement"])
