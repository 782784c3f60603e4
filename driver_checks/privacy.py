"""Reduced views, governed names, audit of query texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_checks.base import check
from maillage import model
from maillage.operators import aggregates
from maillage.plans import privacy
from maillage.session import scratch_path
from maillage.sources.tables import select_tables


# ---------------------------------------------------------------- reduced views
@check("llm_personne", """
    select id, aidant_connect_id, cn_pg_id, coop_id, is_coordinateur, is_mediateur, nb_accompagnements_ac, profession_ac from a_personne""")
def _(t):
    return privacy.safe_view("llm.personne", t.a_personne)


@check("llm_contact", "select c_custkey as id, c_mktsegment as fonction, c_acctbal > 0 as est_referent_fne from customer")
def _(t):
    contact = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nom"), F.col("c_name").alias("prenom"), F.col("c_name").alias("email"),
        F.lit("01").alias("telephone"), F.col("c_mktsegment").alias("fonction"), (F.col("c_acctbal") > 0).alias("est_referent_fne"),
    )
    return privacy.safe_view("llm.contact", contact)


@check("llm_structure_administrative", """
    select id, denomination_sirene, siret, denomination_antenne, old_main_structure_id, departement_code,
      concat('http://s', cast(id as varchar)) as site_web, '01' as telephone, null as nom
    from a_structure_administrative""")
def _(t):
    view = privacy.safe_view("llm.structure_administrative", t.a_structure_administrative)
    keys = {k: F.get_json_object("contact", f"$.{k}") for k in ("site_web", "telephone", "nom")}
    return view.withColumns(keys).drop("contact")


@check("llm_utilisateur", """
    select c_custkey as id, lpad(cast(c_nationkey as varchar), 2, '0') as departement_code, c_acctbal < 0 as is_supprime,
      case c_mktsegment when 'MACHINERY' then 'administrateur_dispositif' else 'gestionnaire_structure' end as role from customer""")
def _(t):
    user = t.customer.select(
        F.col("c_custkey").alias("id"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("departement_code"),
        (F.col("c_acctbal") < 0).alias("is_supprime"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "administrateur_dispositif").otherwise("gestionnaire_structure").alias("role"),
        *[F.col("c_name").alias(c) for c in model.WITHHELD["llm.utilisateur"]],
    )
    return privacy.safe_view("llm.utilisateur", user)


@check("llm_structure", "select s_suppkey as id, s_name as nom, lpad(cast(s_nationkey as varchar), 2, '0') as departement_code from supplier")
def _(t):
    structure = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("nom"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("departement_code"),
        F.lit("{}").alias("contact"), F.lit("1 rue").alias("adresse"),
    )
    return privacy.safe_view("llm.structure", structure)


@check("llm_membre", """
    select cast(o_orderkey as varchar) as id, o_orderstatus as statut, o_orderpriority like '1%' as is_coporteur from orders""")
def _(t):
    member = t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("statut"),
        F.col("o_orderpriority").like("1%").alias("is_coporteur"),
        F.lit("a@b").alias("contact"), F.lit("c@d").alias("contact_technique"),
    )
    return privacy.safe_view("llm.membre", member)


@check("redact_json_keys", "select event_id, json_extract_string(props, '$.k') as k, null as autre from events")
def _(t):
    widened = t.events.select("event_id", F.concat(F.expr("left(props, length(props) - 1)"), F.lit(', "autre": 1}')).alias("props"))
    kept = privacy.redact_json_keys(widened, "props", ["k"])
    return kept.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.autre").alias("autre"))


@check("strip_identifiers", "select id, etat, typologie, date_attribution, date_rendu_poste, created_at, poste_conum_id from a_poste")
def _(t):
    return privacy.strip_identifiers(t.a_poste)


@check("cap_rows", "select id, etat from a_poste order by id limit 10000")
def _(t):
    return privacy.cap_rows(t.a_poste.select("id", "etat").orderBy("id"))


@check("aggregate_only", """
    select structure_id, count(*) as nb, count(distinct personne_id) as nb_personnes from a_poste group by 1 having count(*) >= 5""")
def _(t):
    return aggregates.aggregate_only(t.a_poste, ["structure_id"], {"nb_personnes": F.count_distinct("personne_id")}, 5)


# ---------------------------------------------------------------- audit
TABLE_NAMES = f"""list_sort(list_distinct(list_transform(regexp_extract_all(lower(texte), '{privacy.TABLE_PATTERN}'),
      lambda t: regexp_replace(t, '["\\s]', '', 'g'))))"""


def _sql_list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


ALLOWED = """(t like 'admin.%' or t like 'reference.%' or t like 'llm.%' or t in ('main.subvention', 'main.lieu_inclusion_structure_administrative',
      'min.departement', 'min.region', 'min.groupement', 'min.enveloppe_financement', 'min.departement_enveloppe'))"""
# Names at relation positions, and texts that may hide some, in words of their own.
WORD, GAP = r"[^\s,();.]+", r"[\s(]*(?:(?:only|lateral)\b[\s(]*)*"
PLACE = rf"{WORD}(?:\s*\.\s*{WORD})*"
ITEMS = rf"\b(?:from|join|into|update|table)\b{GAP}{PLACE}(?:(?:[\s)]+(?:as\s+)?{WORD})?[\s)]*,{GAP}{PLACE})*"
PLACED_NAMES = rf"""list_filter(list_transform(flatten(list_transform(regexp_extract_all(regexp_replace(lower(texte), '\b(?:select|with|values)\b', ';', 'g'), '{ITEMS}'), lambda l: string_split(l, ','))),
      lambda i: regexp_replace(regexp_extract(i, '^\s*(?:\b(?:from|join|into|update|table)\b)?{GAP}({PLACE})', 1), '["`\s]', '', 'g')),
      lambda n: n <> '')"""
HIDDEN = r"""(contains(texte, '--') or contains(texte, '/*') or len(list_filter(
      regexp_split_to_array(lower(texte), '\b(?:select|where|group|order|having|limit|union|except|intersect|window|set|values|returning)\b'),
      lambda c: regexp_matches(c, '(?s)\bjoin\b.*,'))) > 0)"""
AUDIT = f"""
    select id, names, list_sort(list_distinct(list_filter(list_concat(names, placed, case when hidden then ['?'] else [] end), lambda t: not {ALLOWED}))) as bad
    from (select id, {TABLE_NAMES} as names, {PLACED_NAMES} as placed, {HIDDEN} as hidden from a_requetes) q"""


@check("audit_queries", f"""
    select id, array_to_string(names, ',') as tables, array_to_string(bad, ',') as refused,
      case when len(list_intersect(bad, {_sql_list(model.TIER_1)})) > 0 then 1 when len(list_intersect(bad, {_sql_list(model.TIER_2)})) > 0 then 2
        when len(list_intersect(bad, {_sql_list(model.TIER_3)})) > 0 then 3 end as strictest_tier,
      len(names) > 0 and len(bad) = 0 as allowed
    from ({AUDIT}) a""")
def _(t):
    out = privacy.audit_queries(t.a_requetes, "id", "texte")
    return out.withColumns({c: F.array_join(c, ",") for c in ("tables", "refused")})


@check("audit_pii_columns", rf"""
    select id, array_to_string(hits, ',') as columns, len(hits) = 0 as allowed from (
      select id, list_sort(list_intersect({_sql_list(model.PII_COLUMNS)}, regexp_extract_all(lower(texte), '[\p{{L}}\p{{N}}_]+'))) as hits from a_requetes) q""")
def _(t):
    out = privacy.audit_pii_columns(t.a_requetes, "id", "texte")
    return out.withColumn("columns", F.array_join("columns", ","))


NEEDLES = " || ".join(
    f"case when contains(lower(texte), '{n}') then '{n},' else '' end" for n in model.SENSITIVE_NEEDLES
)
TEXTS = """select concat('d', cast(doc_id as varchar)) as id, text as texte from documents
      union all select concat('p', cast(page_id as varchar)), html from pages
      union all select concat('c', cast(conv_id as varchar), '-', cast(turn as varchar)), text from conversations
      union all select concat('r', cast(id as varchar)), texte from a_requetes"""


@check("scan_sensitive_text", f"select id, rtrim(found, ',') as needles from (select id, {NEEDLES} as found from ({TEXTS}) t) s where found <> ''")
def _(t):
    texts = (
        t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("texte"))
        .unionByName(t.pages.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), F.col("html").alias("texte")))
        .unionByName(t.conversations.select(
            F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("texte")
        ))
        .unionByName(t.a_requetes.select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"), "texte"))
    )
    found = privacy.scan_sensitive_text(texts, "id", "texte")
    return found.select("id", F.array_join("needles", ",").alias("needles"))


# More needles than are looked for one by one: the beginning of every benchmark text, sought in all documents.
@check("scan_many_needles", """
    with needle as (select distinct lower(substr(text, 5, 30)) as n, dense_rank() over (order by lower(substr(text, 5, 30))) as k from benchmark where length(text) > 4)
    select doc_id, string_agg(n, '|' order by k) as needles from documents join needle on contains(lower(text), n) group by doc_id""")
def _(t):
    beginnings = t.benchmark.where("length(text) > 4").select(F.lower(F.substring("text", 5, 30)).alias("n")).distinct()
    needles = sorted(r["n"] for r in beginnings.collect())  # the list a caller would name
    return privacy.scan_sensitive_text(t.documents, "doc_id", "text", needles).select("doc_id", F.array_join("needles", "|").alias("needles"))


USED_SQL = f"select distinct unnest({TABLE_NAMES}) as table_name from a_requetes"


def _used(t):
    audited = privacy.audit_queries(t.a_requetes, "id", "texte")
    return audited.select(F.explode("tables").alias("table_name")).distinct()


@check("select_tables", f"select t as table_name from (select table_name as t from ({USED_SQL}) u) n where {ALLOWED}")
def _(t):
    return select_tables(_used(t), model.INCLUDE_PATTERNS, model.EXCLUDED)


EXPECTED = "select unnest({}) as table_name".format(_sql_list(sorted(set(model.TIER_1 + model.TIER_2 + model.TIER_3))))


@check("policy_coverage", f"""
    select table_name, 'missing' as finding from ({USED_SQL}) u where table_name not in ({EXPECTED})
    union all select table_name, 'unexpected' from ({EXPECTED}) e where table_name not in ({USED_SQL})""")
def _(t):
    # Names the queries use against the names the policy covers.
    listed = privacy.policy_table(t.spark).where("tier > 0").select("table_name")
    return privacy.policy_coverage(_used(t), listed)


@check("governed_catalog", """
    select departement_code, count(*) as nb_structures, count(old_main_structure_id) as nb_heritees from a_structure_administrative group by 1""")
def _(t):
    root = scratch_path(t.spark, "governed")
    t.a_structure_administrative.write.parquet(f"{root}/main/structure_administrative")
    privacy.governed_catalog(
        t.spark, root, ["main.structure_administrative"], {"llm.structure_administrative": "main.structure_administrative"}
    )
    return t.spark.sql("""
        select departement_code, count(*) as nb_structures, count(old_main_structure_id) as nb_heritees
        from llm__structure_administrative group by departement_code""")
