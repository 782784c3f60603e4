"""The policy cases, and the properties of the reduced views."""

import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from maillage import model
from maillage.plans import privacy
from maillage.sources import profiling, tables

CASES = [
    (1, "SELECT departement_code, COUNT(*) FROM llm.structure GROUP BY 1", True, None),
    (2, "SELECT COUNT(*) FROM llm.personne_enrichie pe JOIN llm.structure_administrative sa ON sa.id = pe.structure_employeuse_id", True, None),
    (3, "select sum(montant_subvention_v2) from main.subvention", True, None),
    (4, "SELECT prenom, nom, contact FROM main.personne LIMIT 10", False, 1),
    (5, "SELECT email_de_contact FROM min.utilisateur", False, 1),
    (6, "SELECT nom, contact FROM main.structure", False, 3),
    (7, "SELECT p.nom FROM main.personne p JOIN main.personne_affectations_emploi e ON e.personne_id = p.id JOIN llm.structure_administrative s ON true", False, 1),
    (8, "select 1 from llm.structure s, Main . \"Poste\" p", False, 2),
    (9, "select 1", False, None),
    (10, "select 1 from min.region where x in (select id from audit.journal)", False, None),
    (11, "select nom from admin.commune c, personne p", False, None),
    (12, "select 1 from admin.commune join secret.notes on true", False, None),
    (13, "select 1 from parquet.`/data/main/personne` p join admin.commune on true", False, None),
    (14, 'select 1 from admin.commune c, admin.region r, "personne"', False, None),
    (15, "select 1 from (select a from admin.commune where b) y, personne", False, None),
    (16, "select 1 from admin.commune c join admin.region r on true, personne", False, None),
    (17, "select 1 from admin.commune/**/, personne", False, None),
    (18, "with villes as (select 1 from admin.commune) select count(*) from villes v", True, None),
    (19, "with personne as (select 1 from admin.commune) select count(*) from personne", False, None),
    (20, "select count(*), max(a), b from (select a, b from llm.structure where c in (1, 2)) s", True, None),
    (21, "select 1 from ((admin.commune)), ((personne))", False, None),
    (22, "select 1 from admin.commune c join llm.structure s on s.id = c.id group by c.a, c.b order by 1, 2", True, None),
    (23, None, False, None),
    (24, "update personne set nom = 1 where id in (select id from admin.commune)", False, None),
]


@pytest.fixture(scope="module")
def audited(spark):
    queries = spark.createDataFrame([c[:2] for c in CASES], "id int, texte string")
    return queries, {r["id"]: r for r in privacy.audit_queries(queries, "id", "texte").collect()}


@pytest.mark.parametrize("case", CASES, ids=[str(c[0]) for c in CASES])
def test_audit(audited, case):
    row = audited[1][case[0]]
    assert row["allowed"] is case[2] and row["strictest_tier"] == case[3]


def test_audit_names_the_tables(audited):
    assert audited[1][7]["refused"] == ["main.personne", "main.personne_affectations_emploi"]
    assert audited[1][8]["tables"] == ["llm.structure", "main.poste"]


def test_audit_needs_no_shuffle(audited):
    plan = privacy.audit_queries(audited[0], "id", "texte")._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_audit_of_columns(spark):
    queries = spark.createDataFrame([(1, "select p.nom, Telephone"), (2, "select nom_commune, prénom"), (3, "select sso_email")], "id int, texte string")
    found = {r["id"]: r["columns"] for r in privacy.audit_pii_columns(queries, "id", "texte").collect()}
    assert found == {1: ["nom", "telephone"], 2: [], 3: ["sso_email"]}


def test_reduced_views_have_no_withheld_column(spark):
    for name, columns in model.WITHHELD.items():
        df = spark.createDataFrame([tuple("x" for _ in columns) + ("1",)], [*columns, "id"])
        assert privacy.safe_view(name, df).columns == ["id"]


def test_columns_nobody_documented_are_not_shown(spark):
    df = spark.createDataFrame([(1, "a@b", "x")], "id int, email_prive string, fonction string")
    assert privacy.safe_view("llm.contact", df).columns == ["id", "fonction"]
    odd = spark.createDataFrame([(1, "x")], "id int, `Nom.complet` string")
    assert privacy.safe_view("llm.personne", odd).columns == ["id"]
    # Columns shown per view, of 23, 9, 26, 18, 12, 14 and 25, and the department; none of them is withheld.
    assert {n: len(c.split()) for n, c in model.SHOWN.items()} == {
        "llm.personne": 18, "llm.contact": 5, "llm.structure_administrative": 27, "llm.utilisateur": 12, "llm.structure": 10, "llm.membre": 12, "llm.personne_enrichie": 20,
    }
    assert not any(set(model.WITHHELD.get(n, ())) & set(c.split()) for n, c in model.SHOWN.items())


def test_withheld_columns_are_not_read(spark, tmp_path):
    path = str(tmp_path / "contact")
    spark.createDataFrame([(1, "a", "b", "c", "d")], "id int, nom string, prenom string, email string, telephone string").write.parquet(path)
    plan = privacy.safe_view("llm.contact", spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:int>" in plan


def test_json_keeps_listed_keys_only(spark):
    texts = [
        '{"nom": "N", "prenom": "P", "courriels": ["a@b"], "site_web": ["http://x"], "telephone": 1}', '{"nom": "N"}', "{}", None, "[1]",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "contact string")
    kept = [r[0] for r in privacy.redact_json_keys(df, "contact", model.ORG_CONTACT_KEYS).collect()]
    assert json.loads(kept[0]) == {"site_web": ["http://x"], "telephone": 1}
    assert kept[1:] == ["{}", "{}", None, None]


def test_catalog_knows_allowed_names_only(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("01", "x", "y", 1)], "departement_code string, contact string, adresse string, id int").write.parquet(f"{root}/min/structure")
    spark.createDataFrame([(5,)], "montant_subvention_v2 int").write.parquet(f"{root}/main/subvention")
    spark.createDataFrame([(1, "n")], "id int, nom string").write.parquet(f"{root}/main/personne")
    names = privacy.governed_catalog(spark, root, ["main.subvention", "main.personne", "min.structure"], {"llm.structure": "min.structure"})
    assert names == ["llm.structure", "main.subvention"]
    assert spark.sql("select sum(montant_subvention_v2) from main__subvention").first()[0] == 5
    assert spark.table("llm__structure").columns == ["departement_code", "id"]
    for refused in ("main__personne", "min__structure"):
        with pytest.raises(AnalysisException):
            spark.sql(f"select * from {refused}")
    with pytest.raises(ValueError):
        privacy.governed_catalog(spark, root, [], {"llm.secret": "main.personne"})


def test_identifiers_are_stripped(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, "x")], "personne_id int, structure_id int, mediateur_coop_id int, nb int, etat string")
    assert privacy.strip_identifiers(df).columns == ["nb", "etat"]


def test_needles(spark):
    docs = spark.createDataFrame([(1, "Write to ME@EXAMPLE.COM"), (2, "nothing"), (3, "PRENOM and Telephone"), (4, None)], "id int, t string")
    found = {r["id"]: r["needles"] for r in privacy.scan_sensitive_text(docs, "id", "t").collect()}
    assert found == {1: ["@example.com"], 3: ["prenom", "telephone"]}


def test_policy_covers_itself(spark):
    expected = spark.createDataFrame([(t,) for t in set(model.TIER_1 + model.TIER_2 + model.TIER_3 + model.NO_REPLACEMENT)], "table_name string")
    listed = spark.createDataFrame([(t,) for t in model.EXCLUDED], "table_name string")
    assert expected.count() == 29 and listed.count() == 30
    assert [tuple(r) for r in privacy.policy_coverage(expected, listed).collect()] == [("min._prisma_migrations", "unexpected")]


def test_inventory_selection(spark):
    inventory = spark.createDataFrame([(t,) for t in ("admin.commune", "main.subvention", "main.personne", "min.region", "mina.region", "llm.membre")], "table_name string")
    chosen = [r[0] for r in tables.select_tables(inventory, model.INCLUDE_PATTERNS, model.EXCLUDED).collect()]
    assert chosen == ["admin.commune", "main.subvention", "min.region", "llm.membre"]


def test_profiles_of_protected_tables_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "id int, nom string")
    with pytest.raises(profiling.ProfilingRefused):
        profiling.profile_columns(df, "main.personne")
    rows = {r["column_name"]: r for r in profiling.profile_columns(df, "admin.region").collect()}
    assert (rows["nom"]["nb_null"], rows["nom"]["min_value"], rows["id"]["approx_distinct"]) == (1, "a", 2)


def test_profiles_of_parts_add_up_to_that_of_the_whole(spark):
    rows = spark.range(5000).selectExpr(
        "cast(id as int) as n", "id % 300 as few", "concat('v', id % 4000) as s", "cast(id as double) / 7 as x", "cast(id as decimal(20,3)) as d",
        "date_add(date'2020-01-01', cast(id as int)) as day", "if(id % 3 = 0, null, id % 2 = 0) as flag", "map('a', id % 10, 'b', 1) as m",
        "named_struct('k', id % 20) as st", "array(id % 5) as l", "parse_json(concat('{\"a\":', id % 7, '}')) as va", "cast(cast(id % 9 as string) as binary) as b", "1 as `odd name`",
    )
    whole = {r["column_name"]: r for r in profiling.profile_columns(rows, "admin.region").collect()}
    parts = [profiling.profile_parts(rows.where(w), "admin.region", w) for w in ("n < 1900", "n >= 1900 and n < 4000", "n >= 4000")]
    stored = parts[0].unionAll(parts[1]).unionAll(parts[2])
    assert {r["column_name"]: r for r in profiling.merge_profiles(stored).collect()} == whole
    assert set(whole) == set(rows.columns) and [whole["n"][c] for c in ("nb", "min_value", "max_value")] == [5000, "0", "4999"]
    assert whole["flag"]["nb_null"] == 1667 and whole["m"]["min_value"] is None and whole["day"]["min_value"] == "2020-01-01"
    for column, exact in (("n", 5000), ("few", 300), ("s", 4000), ("m", 10), ("va", 7), ("st", 20), ("l", 5), ("b", 9), ("flag", 2)):
        assert abs(whole[column]["approx_distinct"] - exact) <= 0.05 * exact
    assert profiling.profile_columns(rows, "admin.region", stored).count() == 0
    assert profiling.profile_columns(rows.where("false"), "admin.region").count() == len(rows.columns)


def test_many_needles_against_brute_force(spark):
    rng = random.Random(8)
    letters = "abcdeé\n .İß😀$(|"
    needles = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 14))) for _ in range(9900)]
    needles += ["".join(rng.choice("xyzä") for _ in range(rng.randint(1, 4))) for _ in range(100)] + ["NEEDLE", "needle", "\x01", "a,b"]
    texts = ["".join(rng.choice(letters + "xyzä") for _ in range(rng.choice((0, 3, 60, 400)))) for _ in range(120)]
    texts += [t + rng.choice(needles).upper() + t for t in texts[:60]] + ["no NeEdLe here", "", None, "q" * 30_000 + "needle"] + ["repeated needle"] * 2
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "id int, texte string, needles string")
    lowered = dict(enumerate(r[0] for r in docs.orderBy("id").select(F.lower("texte")).collect()))
    for sought in (needles, needles[-40:], needles[-10:], ["", *needles[-40:]]):
        order = list(dict.fromkeys(n.lower() for n in sought))
        want = {i: [n for n in order if n in t] for i, t in lowered.items() if t is not None}
        got = privacy.scan_sensitive_text(docs, "id", "texte", sought)
        assert {r["id"]: r["needles"] for r in got.collect()} == {i: found for i, found in want.items() if found}
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan
    assert privacy.scan_sensitive_text(docs.where("false"), "id", "texte", needles).count() == 0


def test_catalog_carries_comments(spark):
    df = tables.with_comments(spark.createDataFrame([(1, 2)], "id int, duree int"), {"duree": "minutes"})
    rows = tables.catalog_columns(spark, {"main.activites_coop": df}).collect()
    assert [(r["column_name"], r["data_type"], r["comment"]) for r in rows] == [("id", "int", None), ("duree", "int", "minutes")]


def test_small_groups_can_be_withheld(spark):
    from maillage.operators.aggregates import aggregate_only

    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "g string, v int")
    assert aggregate_only(df, ["g"], {"total": F.sum("v")}).count() == 2
    assert [tuple(r) for r in aggregate_only(df, ["g"], {"total": F.sum("v")}, 2).collect()] == [("a", 2, 3)]
