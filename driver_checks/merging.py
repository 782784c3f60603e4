"""Merging persons and structures, deduplication, similar names, points in zones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_checks.base import check
from maillage.operators import components, dedupe, links, merging, similarity, spatial

# ---------------------------------------------------------------- pairs and references
MAPPING = """with recursive up as (
      select loser_id as id, winner_id as root_id from a_merge_pairs
      union all select u.id, p.winner_id from up u join a_merge_pairs p on p.loser_id = u.root_id),
    mapping as (select id, root_id from up where root_id not in (select loser_id from a_merge_pairs))"""


def _mapping(t):
    return components.resolve_merge_pairs(t.a_merge_pairs)


@check("resolve_merge_pairs", f"{MAPPING} select id, root_id from mapping")
def _(t):
    return _mapping(t)


@check("merge_pair_conflicts", """with recursive up as (
      select loser_id as id, winner_id as root_id from a_conflicting_pairs
      union select u.id, p.winner_id from up u join a_conflicting_pairs p on p.loser_id = u.root_id)
    select loser_id as id, 'two_winners' as conflict from a_conflicting_pairs group by loser_id having count(distinct winner_id) > 1
    union all
    select distinct u.id, 'circle' from up u join up c on c.id = u.root_id and c.root_id = c.id
    union all
    select distinct id, 'absent_survivor' from up where root_id not in (select loser_id from a_conflicting_pairs) and root_id not in (select id from a_personne)
      and root_id in (select min(winner_id) from a_conflicting_pairs group by loser_id)""")
def _(t):
    return components.merge_pair_conflicts(t.a_conflicting_pairs, t.a_personne)


@check("remap_ids", f"{MAPPING} select e.id, coalesce(m.root_id, e.personne_id) as personne_id from a_emploi e left join mapping m on m.id = e.personne_id")
def _(t):
    return components.remap_ids(t.a_emploi, "personne_id", _mapping(t)).select("id", "personne_id")


@check("drop_losers", f"{MAPPING} select id, nom from a_personne where id not in (select id from mapping)")
def _(t):
    return components.drop_losers(t.a_personne, _mapping(t)).select("id", "nom")


@check("remap_parent", """
    select s.id, coalesce(w.structure_coop_id, s.parent) as structure_parente
    from (select id, case when id > 0 then concat('sc-', cast(id - 1 as string)) end as parent from a_structure) s
    left join (select l.structure_coop_id as old, w.structure_coop_id from a_structure_mapping m
               join a_structure l on l.id = m.id join a_structure w on w.id = m.root_id
               where l.structure_coop_id is not null and w.structure_coop_id is not null) w on w.old = s.parent""")
def _(t):
    codes = t.a_structure.select("id", "structure_coop_id")
    winner = codes.select(F.col("id").alias("root_id"), F.col("structure_coop_id").alias("new"))
    moved = codes.join(t.a_structure_mapping, "id").join(winner, "root_id").dropna(subset=["structure_coop_id", "new"])
    children = codes.select("id", F.when(F.col("id") > 0, F.concat(F.lit("sc-"), (F.col("id") - 1).cast("string"))).alias("structure_parente"))
    return components.remap_parent(children, "structure_parente", moved.select(F.col("structure_coop_id").alias("id"), F.col("new").alias("root_id")))


# ---------------------------------------------------------------- persons
GAPS = ("aidant_connect_id", "cn_pg_id", "nb_accompagnements_ac", "profession_ac", "is_mediateur", "coop_id")
MERGED_PERSONS = f"""{MAPPING},
    absorbed as (select m.root_id, p.* from a_personne p join mapping m on m.id = p.id),
    fill as (select root_id,
      {', '.join(f"arg_min({c}, id) filter (where {c} is not null) as {c}" for c in GAPS)},
      arg_min(contact, id) filter (where contact is not null and contact <> '{{ }}') as contact,
      arg_max_null(contact, id) as last_contact from absorbed group by root_id),
    merged as (select p.id, p.prenom, p.is_coordinateur, {', '.join(f'coalesce(p.{c}, f.{c}) as {c}' for c in GAPS)},
      case when f.root_id is null then p.contact else coalesce(case when p.contact <> '{{ }}' then p.contact end, f.contact, f.last_contact) end as contact
      from a_personne p left join fill f on f.root_id = p.id where p.id not in (select id from mapping))"""


@check("merge_personne_fields", f"{MERGED_PERSONS} select * from merged")
def _(t):
    people = t.a_personne.select("id", "prenom", "is_coordinateur", *GAPS, "contact")
    return merging.merge_personne_fields(people, _mapping(t))


PLACED = """placed as (select l.*, m.root_id, coalesce(m.root_id, l.personne_id) as p from a_person_links l left join mapping m on m.id = l.personne_id)"""
KEPT_LINKS = """select x.id, x.p as personne_id, x.structure_id, x.type, x.suppression from placed x
    where x.root_id is null or not exists (
      select 1 from placed y where y.p = x.p and y.structure_id = x.structure_id and y.type = x.type
        and y.suppression is not distinct from x.suppression
        and (y.root_id is null or y.personne_id < x.personne_id))"""


@check("merge_persons", f"""{MERGED_PERSONS},
    {PLACED}
    select 'personne' as table_name, id, cast(null as bigint) as personne_id, cast(null as bigint) as autre_id, coop_id as valeur from merged
    union all select 'personne_affectations', id, personne_id, structure_id, type from ({KEPT_LINKS}) l
    union all select 'personne_affectations_emploi', e.id, coalesce(m.root_id, e.personne_id), e.structure_administrative_id, e.source
      from a_emploi e left join mapping m on m.id = e.personne_id
    union all select 'contrat', c.id, coalesce(m.root_id, c.personne_id), c.structure_id, null from a_contrat c left join mapping m on m.id = c.personne_id
    union all select 'formation', c.id, coalesce(m.root_id, c.personne_id), null, c.label from a_formation c left join mapping m on m.id = c.personne_id
    union all select 'coordination_mediation', c.id, coalesce(mc.root_id, c.coordinateur_id), coalesce(mm.root_id, c.mediateur_id),
      case when mm.id is null then c.mediateur_coop_id else pm.coop_id end
      from a_coordination c left join mapping mc on mc.id = c.coordinateur_id
      left join mapping mm on mm.id = c.mediateur_id left join merged pm on pm.id = mm.root_id""")
def _(t):
    tables = {
        "personne": t.a_personne.select("id", "coop_id"), "personne_affectations": t.a_person_links, "personne_affectations_emploi": t.a_emploi,
        "contrat": t.a_contrat, "formation": t.a_formation, "coordination_mediation": t.a_coordination,
    }
    shown = {
        "personne": (None, None, "coop_id"), "personne_affectations": ("personne_id", "structure_id", "type"),
        "personne_affectations_emploi": ("personne_id", "structure_administrative_id", "source"), "contrat": ("personne_id", "structure_id", None),
        "formation": ("personne_id", None, "label"), "coordination_mediation": ("coordinateur_id", "mediateur_id", "mediateur_coop_id"),
    }
    return _union(merging.merge_persons(tables, _mapping(t)), shown, ("personne_id", "autre_id", "valeur"))


def _union(tables, shown, names):
    """All tables under one another: table name, id, two keys, a text."""

    def part(name, columns):
        kinds = ("bigint", "bigint", "string")
        cells = [(F.col(c) if c else F.lit(None)).cast(k).alias(n) for c, k, n in zip(columns, kinds, names, strict=True)]
        return tables[name].select(F.lit(name).alias("table_name"), F.col("id").cast("bigint").alias("id"), *cells)

    return reduce(DataFrame.unionByName, [part(name, columns) for name, columns in shown.items()])


@check("merge_personne_links", f"""{MAPPING},
    placed as (select l.*, m.root_id, coalesce(m.root_id, l.personne_id) as p from a_person_links l left join mapping m on m.id = l.personne_id)
    select x.id, x.p as personne_id, x.structure_id, x.type, x.suppression from placed x
    where x.root_id is null or not exists (
      select 1 from placed y where y.p = x.p and y.structure_id = x.structure_id and y.type = x.type
        and y.suppression is not distinct from x.suppression
        and (y.root_id is null or y.personne_id < x.personne_id))""")
def _(t):
    return merging.merge_personne_links(t.a_person_links, _mapping(t))


@check("merge_coordination", f"""{MERGED_PERSONS}
    select c.id, coalesce(mc.root_id, c.coordinateur_id) as coordinateur_id, coalesce(mm.root_id, c.mediateur_id) as mediateur_id,
      case when mc.id is null then c.coordinateur_coop_id else pc.coop_id end as coordinateur_coop_id,
      case when mm.id is null then c.mediateur_coop_id else pm.coop_id end as mediateur_coop_id
    from a_coordination c
    left join mapping mc on mc.id = c.coordinateur_id left join merged pc on pc.id = mc.root_id
    left join mapping mm on mm.id = c.mediateur_id left join merged pm on pm.id = mm.root_id""")
def _(t):
    mapping = _mapping(t)
    people = merging.merge_personne_fields(t.a_personne.select("id", "coop_id"), mapping)
    return merging.merge_coordination(t.a_coordination.drop("suppression"), people, mapping)


# ---------------------------------------------------------------- structures
@check("merge_structure_ids", """
    select w.id, coalesce(l.structure_coop_id, w.structure_coop_id) as structure_coop_id, coalesce(l.structure_ac_id, w.structure_ac_id) as structure_ac_id,
      coalesce(l.structure_cartographie_nationale_id, w.structure_cartographie_nationale_id) as structure_cartographie_nationale_id
    from a_structure w left join a_structure_mapping m on m.root_id = w.id left join a_structure l on l.id = m.id
    where w.id not in (select id from a_structure_mapping)""")
def _(t):
    return merging.merge_structure_ids(t.a_structure.select("id", *merging.STRUCTURE_IDS), t.a_structure_mapping)


def _clean_union(w: str, l: str) -> str:
    lists = f"list_distinct(list_filter(list_concat(string_split({w}, '|'), string_split({l}, '|')), lambda e: e is not null and e <> ''))"
    return f"array_to_string(list_sort(case when {w} is not null and {l} is not null then {lists} else string_split(coalesce({w}, {l}), '|') end), ',')"


@check("merge_structure_fields", f"""
    select w.id, w.nom, coalesce(w.denomination_sirene, l.denomination_sirene) as denomination_sirene, coalesce(w.siret, l.siret) as siret,
      coalesce(w.emplois, l.emplois) as emplois,
      case when m.id is null then w.source else coalesce(nullif(w.source, ''), l.source) end as source,
      case when m.id is null then w.last_sirene_enrich_at
        else greatest(coalesce(w.last_sirene_enrich_at, date '1900-01-01'), coalesce(l.last_sirene_enrich_at, date '1900-01-01')) end as last_sirene_enrich_at,
      {_clean_union('w.typologies_texte', 'l.typologies_texte')} as typologies, {_clean_union('w.frais_texte', 'l.frais_texte')} as frais_a_charge
    from a_structure w left join a_structure_mapping m on m.root_id = w.id left join a_structure l on l.id = m.id
    where w.id not in (select id from a_structure_mapping)""")
def _(t):
    rows = t.a_structure.select(
        "id", "nom", "denomination_sirene", "siret", "emplois", "source", "last_sirene_enrich_at",
        F.split("typologies_texte", r"\|").alias("typologies"), F.split("frais_texte", r"\|").alias("frais_a_charge"),
    )
    out = merging.merge_structure_fields(rows, t.a_structure_mapping)
    lists = {c: F.array_join(F.array_sort(c), ",") for c in ("typologies", "frais_a_charge")}
    return out.withColumns(lists)


@check("merge_structure_rows", f"""
    select w.id, w.nom, coalesce(l.structure_coop_id, w.structure_coop_id) as structure_coop_id, coalesce(l.structure_ac_id, w.structure_ac_id) as structure_ac_id,
      coalesce(w.siret, l.siret) as siret, coalesce(w.emplois, l.emplois) as emplois,
      case when m.id is null then w.source else coalesce(nullif(w.source, ''), l.source) end as source,
      {_clean_union('w.typologies_texte', 'l.typologies_texte')} as typologies, {_clean_union('w.frais_texte', 'l.frais_texte')} as frais_a_charge
    from a_structure w left join a_structure_mapping m on m.root_id = w.id left join a_structure l on l.id = m.id
    where w.id not in (select id from a_structure_mapping)""")
def _(t):
    rows = t.a_structure.select(
        "id", "nom", "structure_coop_id", "structure_ac_id", "siret", "emplois", "source",
        F.split("typologies_texte", r"\|").alias("typologies"), F.split("frais_texte", r"\|").alias("frais_a_charge"),
    )
    out = merging.merge_structure_rows(rows, t.a_structure_mapping)
    return out.withColumns({c: F.array_join(F.array_sort(c), ",") for c in ("typologies", "frais_a_charge")})


# Every structure is the child of the one before it; positions and members hang on structures.
@check("merge_structures", """
    with moved as (select old, min(new) as new from (
        select x.structure_coop_id as old, coalesce(l.structure_coop_id, w.structure_coop_id) as new
        from a_structure_mapping m join a_structure w on w.id = m.root_id join a_structure l on l.id = m.id
          join a_structure x on x.id in (m.id, m.root_id)) z where old <> new group by old)
    select 'structure' as table_name, w.id, cast(null as bigint) as structure_id, coalesce(l.structure_coop_id, w.structure_coop_id) as coop,
      coalesce(v.new, concat('sc-', cast(w.id - 1 as varchar))) as parente
    from a_structure w left join a_structure_mapping m on m.root_id = w.id left join a_structure l on l.id = m.id
      left join moved v on v.old = concat('sc-', cast(w.id - 1 as varchar))
    where w.id not in (select id from a_structure_mapping)
    union all select 'poste', p.id, coalesce(m.root_id, p.structure_id), null, p.etat from a_poste p left join a_structure_mapping m on m.id = p.structure_id""")
def _(t):
    parent = F.concat(F.lit("sc-"), (F.col("id") - 1).cast("string")).alias("structure_parente")
    tables = {"structure": t.a_structure.select("id", "structure_coop_id", parent), "poste": t.a_poste}
    out = merging.merge_structures(tables, t.a_structure_mapping)
    structures = out["structure"].select(F.lit("structure").alias("table_name"), "id", F.lit(None).cast("bigint").alias("structure_id"), F.col("structure_coop_id").alias("coop"), F.col("structure_parente").alias("parente"))
    positions = out["poste"].select(F.lit("poste").alias("table_name"), "id", "structure_id", F.lit(None).cast("string").alias("coop"), F.col("etat").alias("parente"))
    return structures.unionByName(positions)


# ---------------------------------------------------------------- links, step by step
# Each step as SQL over a table of links, so the steps can be checked alone and chained.
SLOT = "{a}.personne_id = {b}.personne_id and {a}.type = {b}.type and {a}.suppression is not distinct from {b}.suppression"
COOPS = "{a}.structure_coop_id is not distinct from {b}.structure_coop_id and {a}.mediateur_coop_id is not distinct from {b}.mediateur_coop_id"


def _slot(a, b):
    return SLOT.format(a=a, b=b)


def _coops(a, b):
    return COOPS.format(a=a, b=b)


FILL = """arg_min(structure_coop_id, id) filter (where structure_coop_id is not null) as fs,
      arg_min(mediateur_coop_id, id) filter (where mediateur_coop_id is not null) as fm"""
HEAD = "r.id, r.personne_id, r.structure_id, r.type"


def sql_collision(L):
    hit = f"""exists (select 1 from {L} l where l.structure_id = p.loser_id and l.type = r.type
      and l.suppression is not distinct from r.suppression and {_coops('l', 'r')})"""
    return f"""select {HEAD}, case when {hit} then null else r.structure_coop_id end as structure_coop_id,
      case when {hit} then null else r.mediateur_coop_id end as mediateur_coop_id, r.suppression
      from {L} r left join a_link_pairs p on p.winner_id = r.structure_id"""


def sql_orphan_collision(L):
    hit = f"""exists (select 1 from {L} o where o.structure_id is null and o.structure_coop_id = p.loser_coop_id and o.type = r.type
      and o.mediateur_coop_id is not distinct from r.mediateur_coop_id and o.suppression is not distinct from r.suppression)"""
    return f"""select {HEAD}, case when {hit} then null else r.structure_coop_id end as structure_coop_id,
      case when {hit} then null else r.mediateur_coop_id end as mediateur_coop_id, r.suppression
      from {L} r left join a_link_pairs p on p.winner_id = r.structure_id"""


def sql_fold(L):
    return f"""select {HEAD}, coalesce(r.structure_coop_id, f.fs) as structure_coop_id, coalesce(r.mediateur_coop_id, f.fm) as mediateur_coop_id, r.suppression
      from {L} r left join a_link_pairs pw on pw.winner_id = r.structure_id left join a_link_pairs pl on pl.loser_id = r.structure_id
      left join (select p.winner_id, l.personne_id, l.type, l.suppression, {FILL} from {L} l join a_link_pairs p on p.loser_id = l.structure_id
                 group by 1, 2, 3, 4) f on f.winner_id = pw.winner_id and {_slot('f', 'r')}
      where pl.loser_id is null or not exists (select 1 from {L} x where x.structure_id = pl.winner_id and {_slot('x', 'r')})"""


def sql_repoint(L):
    return f"""select r.id, r.personne_id,
      case when p.loser_id is not null and not exists (select 1 from {L} x where x.structure_id = p.winner_id and {_slot('x', 'r')})
        then p.winner_id else r.structure_id end as structure_id,
      r.type, r.structure_coop_id, r.mediateur_coop_id, r.suppression
      from {L} r left join a_link_pairs p on p.loser_id = r.structure_id"""


def sql_attach(L):
    return f"""select r.id, r.personne_id,
      case when p.loser_id is not null and not exists (select 1 from {L} x where x.structure_id = p.winner_id and {_slot('x', 'r')})
        then p.winner_id else r.structure_id end as structure_id,
      r.type, r.structure_coop_id, r.mediateur_coop_id, r.suppression
      from {L} r left join a_link_pairs p on r.structure_id is null and p.loser_coop_id = r.structure_coop_id
      where p.loser_id is null or not exists (select 1 from {L} x where x.structure_id = p.winner_id and {_slot('x', 'r')} and {_coops('x', 'r')})"""


def sql_closed(L):
    return f"""select p.winner_id, l.personne_id, l.type, max(l.suppression) as closed from {L} l join a_link_pairs p on p.loser_id = l.structure_id
      where l.suppression is not null group by 1, 2, 3"""


def sql_close_dates(L, closed):
    return f"""select {HEAD}, coalesce(r.structure_coop_id, f.fs) as structure_coop_id, coalesce(r.mediateur_coop_id, f.fm) as mediateur_coop_id,
        case when r.opened and not exists (select 1 from {L} x where x.id <> r.id and x.type = r.type and x.suppression = r.closed and {_coops('x', 'r')})
          then r.closed else r.suppression end as suppression
      from (select w.*, c.closed, w.suppression is null and c.closed is not null as opened from {L} w left join ({closed}) c
            on c.winner_id = w.structure_id and c.personne_id = w.personne_id and c.type = w.type) r
      left join (select w.structure_id, w.personne_id, w.type, c.closed, {FILL} from {L} w join ({closed}) c
                 on c.winner_id = w.structure_id and c.personne_id = w.personne_id and c.type = w.type where w.suppression is null group by 1, 2, 3, 4) f
        on f.structure_id = r.structure_id and f.personne_id = r.personne_id and f.type = r.type and f.closed = r.suppression
      where not (r.opened and exists (select 1 from {L} y where y.structure_id = r.structure_id and y.personne_id = r.personne_id
                                      and y.type = r.type and y.suppression = r.closed))"""


def sql_collapse(L):
    same = "x.structure_id = r.structure_id and x.personne_id = r.personne_id and x.type = r.type"
    return f"""select {HEAD}, case when p.winner_id is null then r.structure_coop_id else coalesce(r.structure_coop_id, f.fs) end as structure_coop_id,
        case when p.winner_id is null then r.mediateur_coop_id else coalesce(r.mediateur_coop_id, f.fm) end as mediateur_coop_id, r.suppression
      from {L} r left join a_link_pairs p on p.winner_id = r.structure_id
      left join (select structure_id, personne_id, type, {FILL} from {L} where suppression is null group by 1, 2, 3) f
        on r.suppression is not null and f.structure_id = r.structure_id and f.personne_id = r.personne_id and f.type = r.type
      where p.winner_id is null or r.suppression is not null
        or not exists (select 1 from {L} x where {same} and x.suppression is not null)"""


def sql_guard(L):
    same = "structure_coop_id, mediateur_coop_id, type, suppression"
    return f"""select {HEAD}, case when r.scope and (n > 1 or (r.winner_id is null and r.held)) then null else r.structure_coop_id end as structure_coop_id,
        r.mediateur_coop_id, r.suppression
      from (select g.*, row_number() over (partition by scope, winner_id, {same} order by id) as n,
                   bool_or(scope and winner_id is not null) over (partition by {same}) as held
            from (select l.*, p.winner_id, l.structure_coop_id is not null and (p.winner_id is not null or l.structure_id is null) as scope
                  from {L} l left join a_link_pairs p on p.winner_id = l.structure_id) g) r"""


@check("links_collision_null", sql_collision("a_links"))
def _(t):
    return links.links_collision_null(t.a_links, t.a_link_pairs)


@check("links_orphan_collision_null", sql_orphan_collision("a_links"))
def _(t):
    return links.links_orphan_collision_null(t.a_links, t.a_link_pairs)


@check("links_fold_pairs", sql_fold("a_links"))
def _(t):
    return links.links_fold_pairs(t.a_links, t.a_link_pairs)


@check("links_repoint_rest", sql_repoint("a_links"))
def _(t):
    return links.links_repoint_rest(t.a_links, t.a_link_pairs)


@check("links_attach_orphans", sql_attach("a_links"))
def _(t):
    return links.links_attach_orphans(t.a_links, t.a_link_pairs)


@check("links_keep_close_dates", sql_close_dates("a_links", sql_closed("a_links")))
def _(t):
    closed = links.closed_of_losers(t.a_links, t.a_link_pairs)
    return links.links_keep_close_dates(t.a_links, t.a_link_pairs, closed)


@check("links_collapse_active_closed", sql_collapse("a_links"))
def _(t):
    return links.links_collapse_active_closed(t.a_links, t.a_link_pairs)


@check("links_dedupe_guard", sql_guard("a_links"))
def _(t):
    return links.links_dedupe_guard(t.a_links, t.a_link_pairs)


def _chain() -> str:
    steps = [
        ("s0", sql_closed("a_links")), ("s1", sql_collision("a_links")), ("s2", sql_orphan_collision("s1")), ("s3", sql_fold("s2")),
        ("s4", sql_repoint("s3")), ("s5", sql_attach("s4")), ("s6", sql_close_dates("s5", "select * from s0")), ("s7", sql_collapse("s6")),
    ]
    return "with " + ",\n".join(f"{n} as materialized ({sql})" for n, sql in steps) + "\n" + sql_guard("s7")


@check("merge_links", _chain())
def _(t):
    return links.merge_links(t.a_links, t.a_link_pairs)


# ---------------------------------------------------------------- duplicates
@check("dedupe_adresse", """
    select id, kept_id from (select id, min(id) over (partition by code_postal, nom_commune, nom_voie, coalesce(numero_voie, 0), coalesce(repetition, '')) as kept_id
                             from a_adresse) x where id <> kept_id""")
def _(t):
    return dedupe.dedupe_adresse(t.a_adresse)


@check("dedupe_structure_siret", """
    select id, kept_id from (select id, min(id) over (partition by siret, antenne) as kept_id
      from (select id, siret, case when denomination_antenne is not null then 'antenne' end as antenne from a_structure_administrative
            union all select id + 1000000, siret, null from a_structure_administrative) s) x where id <> kept_id""")
def _(t):
    first = t.a_structure_administrative.select(
        "id", "siret", F.when(F.col("denomination_antenne").isNotNull(), "antenne").alias("denomination_antenne")
    )
    again = first.select((F.col("id") + 1000000).alias("id"), "siret", F.lit(None).cast("string").alias("denomination_antenne"))
    return dedupe.dedupe_structure_siret(first.unionByName(again))


@check("dedupe_personne_ids", """with recursive edge as (
      select p.id as a, q.id as b from a_personne p join a_personne q on q.aidant_connect_id = p.aidant_connect_id
      union select p.id, q.id from a_personne p join a_personne q on q.cn_pg_id = p.cn_pg_id),
    reach as (select a, b from edge union select r.a, e.b from reach r join edge e on e.a = r.b)
    select a as id, min(b) as kept_id from reach group by a having min(b) < a""")
def _(t):
    return dedupe.dedupe_personne_ids(t.a_personne, ["aidant_connect_id", "cn_pg_id"])


@check("fuzzy_name_pairs", r"""
    with named as (select lower(nom) as nom, min(id) as id, count(*) as nb from a_noms group by lower(nom)),
    gram as (select distinct nom, unnest(list_transform(range(1, length(w) - 1), lambda i: substr(w, i, 3))) as g
             from (select nom, concat('  ', unnest(list_filter(regexp_split_to_array(nom, '[^\p{L}\p{N}]+'), lambda x: x <> '')), ' ') as w from named) p),
    size as (select nom, count(*) as n from gram group by nom),
    shared as (select a.nom as nom_a, b.nom as nom_b, count(*) as communs from gram a join gram b on b.g = a.g and a.nom < b.nom group by 1, 2)
    select s.nom_a, s.nom_b, x.id as id_a, y.id as id_b, x.nb as nb_a, y.nb as nb_b, s.communs, s.communs / (m.n + n.n - s.communs) as similarite
    from shared s join size m on m.nom = s.nom_a join size n on n.nom = s.nom_b join named x on x.nom = s.nom_a join named y on y.nom = s.nom_b
    where 10 * s.communs >= 3 * (m.n + n.n - s.communs)""")
def _(t):
    return similarity.fuzzy_name_pairs(t.a_noms, "nom")


@check("split_structure", """
    select 'sites' as table_name, id, id as other_id, nom, null as siret, null as denomination_antenne, null as emplois from a_structure
    union all select 'entities', id, id, null, siret, denomination_sirene, emplois
      from (select *, row_number() over (partition by siret, denomination_sirene order by id) as n from a_structure
            where siret is not null or denomination_sirene is not null) x where n = 1
    union all select 'bridge', id, min(id) over (partition by siret, denomination_sirene), null, null, null, null
      from a_structure where siret is not null or denomination_sirene is not null""")
def _(t):
    legacy = t.a_structure.withColumnRenamed("denomination_sirene", "denomination_antenne")
    sites, entities, bridge = dedupe.split_structure(legacy, ["nom"], ["emplois"])
    named = [("sites", sites.withColumnRenamed("old_main_structure_id", "other_id")), ("entities", entities.withColumnRenamed("old_main_structure_id", "other_id")),
             ("bridge", bridge.toDF("id", "other_id"))]
    parts = [df.withColumn("table_name", F.lit(name)) for name, df in named]
    out = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return out.select("table_name", "id", "other_id", "nom", "siret", "denomination_antenne", "emplois")


@check("merge_import_warnings", """
    select id, case when siret is null and emplois is null then '["siret_absent","emplois_absents"]' when siret is null then '["siret_absent"]'
      when emplois is null then '["emplois_absents"]' end as import_warnings from a_structure""")
def _(t):
    rules = {"siret_absent": F.col("siret").isNotNull(), "emplois_absents": F.col("emplois").isNotNull()}
    return dedupe.merge_import_warnings(t.a_structure, rules).select("id", "import_warnings")


# ---------------------------------------------------------------- points in zones
BOX = """select s_suppkey as zone_id, cast((s_suppkey % 20) * 0.05 - 0.5 as double) as x0, cast((s_suppkey % 19) * 0.05 - 0.5 as double) as y0,
      cast((s_suppkey % 20) * 0.05 - 0.42 as double) as x1, cast((s_suppkey % 19) * 0.05 - 0.42 as double) as y1 from {supplier}"""


@check("join_point_in_polygon", f"""
    select e.vec_id, z.zone_id from embeddings e join ({BOX.format(supplier='supplier')}) z
    on e.embedding[1]::double >= z.x0 and e.embedding[1]::double < z.x1 and e.embedding[2]::double >= z.y0 and e.embedding[2]::double < z.y1""")
def _(t):
    points = t.embeddings.select(
        "vec_id", F.col("embedding")[0].cast("double").alias("lon"), F.col("embedding")[1].cast("double").alias("lat")
    )
    box = t.spark.sql(BOX, supplier=t.supplier)

    def corner(x, y):
        return F.struct(F.col(x).alias("lon"), F.col(y).alias("lat"))

    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    zones = box.select("zone_id", F.array(F.array(ring)).alias("geom"))
    return spatial.join_point_in_polygon(points, zones, 0.1).select("vec_id", "zone_id")
