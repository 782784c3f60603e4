"""Rules, deletions, loading by key, sources."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from maillage import model
from maillage.operators import joins, quality, upserts
from maillage.operators.ordering import latest_by, neutralise_rest
from maillage.plans import grants, territory
from maillage.session import scratch_path, shared_folder
from maillage.sources import landing, refresh, tables


def as_set(df):
    return {tuple(r) for r in df.collect()}


# ---------------------------------------------------------------- rules
def test_model_is_complete():
    assert len(model.FOREIGN_KEYS) == 59
    # 36 constraints and 13 indexes, two of which repeat a constraint.
    assert len(model.UNIQUE_KEYS) == 47
    # 13 row rules, with the enumerated type and the zone types as two more domains.
    assert len(model.CHECKS) + len(model.DOMAINS) == 15
    assert model.primary_key("min.region") == ("code",) and model.primary_key("main.poste") == ("id",)


def test_unknown_passes_a_check(spark):
    df = spark.createDataFrame([(1, "rendu", None), (2, "rendu", date(2020, 1, 1)), (3, None, None), (4, "vacant", None)], "id int, etat string, date_rendu_poste date")
    rule = next(c.predicate for c in model.CHECKS if c.name == "poste_rendu")
    assert [r["id"] for r in quality.dq_check(df, rule).collect()] == [1]
    assert quality.dq_domain(df, "etat", model.DOMAINS[("main.poste", "etat")]).count() == 0


def test_unique_with_null_part(spark):
    df = spark.createDataFrame([(None, "x"), (None, "x"), ("a", "x"), ("a", "x"), ("b", "x")], "siret string, antenne string")
    assert as_set(quality.dq_unique(df, ["siret", "antenne"])) == {("a", "x", 2)}
    assert as_set(quality.dq_unique(df, ["siret", "antenne"], nulls_equal=True)) == {("a", "x", 2), (None, "x", 2)}
    assert as_set(quality.dq_unique(df, ["antenne"], where="siret = 'a'")) == {("x", 2)}
    assert as_set(quality.dq_unique(df, ["coalesce(siret, 'b')"])) == {("a", 2), ("b", 3)}
    assert as_set(quality.dq_primary_key(df, ["siret"])) == {("a", 2), (None, 2)}


def test_declared_unique_keys_are_valid_expressions(spark):
    links = spark.createDataFrame(
        [(1, 2, None), (1, 2, None), (1, 2, datetime(2020, 1, 1))], "coordinateur_id int, mediateur_id int, suppression timestamp"
    )
    rule = next(u for u in model.UNIQUE_KEYS if u.table == "main.coordination_mediation")
    assert quality.dq_unique(links, rule.keys).first()["nb"] == 2
    addresses = spark.createDataFrame(
        [("1", "c", None, None, None), ("1", "c", None, 0, "")], "code_postal string, nom_commune string, nom_voie string, numero_voie smallint, repetition string"
    )
    rule = next(u for u in model.UNIQUE_KEYS if u.table == "main.adresse" and u.nulls_equal)
    assert quality.dq_unique(addresses, rule.keys, rule.nulls_equal).first()["nb"] == 2


def test_report_covers_every_kind_of_rule(spark):
    region = spark.createDataFrame([(1, "01", "N", "g"), (2, "001", None, "g"), (2, "01", "N", None)], "id int, code string, nom string, geom string")
    departement = spark.createDataFrame([(1, 1, "01", "d", "g"), (2, 9, "02", "d", "g"), (3, None, "03", "d", "g")], "id int, region_id int, code string, nom string, geom string")
    found = {(r["table_name"], r["rule"]): r["violations"] for r in quality.dq_report({"admin.region": region, "admin.departement": departement}).collect()}
    assert found[("admin.region", "not_null:nom")] == 1 and found[("admin.region", "not_null:geom")] == 1
    assert found[("admin.region", "length:code")] == 1 and found[("admin.region", "unique:code")] == 1
    assert found[("admin.departement", "foreign_key:region_id")] == 1 and found[("admin.departement", "not_null:region_id")] == 1
    assert found[("admin.departement", "length:code")] == 0


def test_report_names_what_it_cannot_test(spark):
    rows = spark.createDataFrame([(1, 5, "rendu")] * 3 + [(2, None, "odd")], "id int, structure_id int, etat string")
    found = {(r["table_name"], r["rule"]): r["violations"] for r in quality.dq_report({"main.poste": rows}).collect()}
    assert found[("main.poste", "missing_column:check:poste_rendu")] is None
    assert found[("main.poste", "missing_column:unique:poste_conum_id, structure_id, personne_id")] is None
    assert found[("main.poste", "missing_table:foreign_key:structure_id")] is None
    assert (found[("main.poste", "domain:etat")], found[("main.poste", "primary_key:id")], found[("main.poste", "not_null:id")]) == (1, 1, 0)
    # Every declared rule on the table, and nothing twice.
    declared = [c for c in model.CHECKS if c.table == "main.poste"] + [d for d in model.DOMAINS if d[0] == "main.poste"]
    declared += [u for u in model.UNIQUE_KEYS if u.table == "main.poste"] + [k for k in model.FOREIGN_KEYS if k.child == "main.poste"]
    assert len(found) == len(declared) + 3 + 3 + 1  # required columns, lengths, primary key


def test_report_compares_keys_by_value(spark):
    parents = spark.createDataFrame([(1, "a\",\"b"), (2, "c"), (2, None)], "id int, code string")
    children = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 3), (5, None)], "id long, ref long")
    key = model.ForeignKey("c", "ref", "p", "id")
    uniques = [model.Unique("p", ("id", "code")), model.Unique("p", ("id", "code"), nulls_equal=True), model.Unique("p", ("coalesce(code, 'c')",)), model.Unique("c", ("ref",), where="id < 4")]
    out = quality.dq_report({"p": parents, "c": children}, {}, uniques, [key])
    assert sorted((r["table_name"], r["rule"], r["violations"]) for r in out.collect()) == [
        ("c", "foreign_key:ref", 2), ("c", "unique:ref where id < 4", 0), ("p", "unique:coalesce(code, 'c')", 1), ("p", "unique:id, code", 0), ("p", "unique:id, code", 0),
    ]
    assert quality.dq_report({"p": parents.where("false")}, {}, uniques, []).where("violations <> 0").count() == 0


def test_report_reads_each_table_once(spark):
    from driver_checks import QUERIES
    from driver_checks.quality import REPORTED

    plan = QUERIES["dq_report"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    # An adapter is one scan of a given table; of all rules there are two aggregates, and those of the two adapters that group.
    assert plan.count("FileScan parquet") == len(REPORTED) and plan.count("Exchange") <= 7



def test_deletions(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, parent int")
    gone = spark.createDataFrame([(5,), (5,), (7,)], "pid int")

    def run(rule):
        return as_set(quality.cascade_delete(child, "parent", gone, "pid", rule))

    assert run("CASCADE") == {(2, 6), (3, None)}
    assert run("SET NULL") == {(1, None), (2, 6), (3, None)}
    assert run("RESTRICT") == run("NO ACTION") == {(1, 5)}
    with pytest.raises(ValueError):
        run("IGNORE")


# ---------------------------------------------------------------- loading
STAMP = datetime(2026, 1, 1)


def test_upsert(spark):
    schema = "k1 int, k2 string, v int, updated_at timestamp"
    target = spark.createDataFrame([(1, "a", 10, None), (2, "a", 20, None), (3, "a", 30, None), (4, None, 40, None)], schema)
    updates = spark.createDataFrame(
        [(1, "a", 10, None, 1), (2, "a", 21, None, 1), (2, "a", 22, None, 2), (5, "a", 50, None, 1), (4, None, 41, None, 1), (4, None, 42, None, 1), (3, "a", None, None, 7)],
        schema + ", version int",
    )
    got = as_set(upserts.upsert(target, updates, ["k1", "k2"], "version", F.lit(STAMP)))
    assert got == {
        (1, "a", 10, None), (2, "a", 22, STAMP), (3, "a", None, STAMP), (5, "a", 50, None), (4, None, 40, None), (4, None, 41, None), (4, None, 42, None),
    }
    # Repeats equal in the order column are settled by their content, in whichever order they come.
    ties = spark.createDataFrame([(2, "a", 29, None, 5), (2, "a", 25, None, 5)], schema + ", version int")
    for rows in (ties, ties.orderBy("v"), ties.orderBy(F.desc("v"))):
        assert (2, "a", 25, None) in as_set(upserts.upsert(target, rows, ["k1", "k2"], "version"))
    # A second load of the same rows changes nothing but the NULL keys, which equal nothing.
    keyed = updates.where("k2 is not null")
    once = upserts.upsert(target, keyed, ["k1", "k2"], "version")
    assert as_set(upserts.upsert(once, keyed, ["k1", "k2"], "version")) == as_set(once)


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_stored_upsert_rewrites_touched_parts_only(spark):
    schema = "k1 int, k2 string, v int, updated_at timestamp"
    rows = [(i, "a", i, None) for i in range(200)] + [(7, None, 1, None), (7, None, 1, None)]
    target = spark.createDataFrame(rows, schema)
    updates = spark.createDataFrame([(3, "a", 33, None, 1), (3, "a", 34, None, 2), (500, "a", 5, None, 1), (9, None, 9, None, 1)], schema + ", version int")
    table = upserts.StoredTarget(scratch_path(spark, "target"), ("k1", "k2"), 32)
    table.write(target)
    before = files_of(table.path)
    touched = table.upsert(updates, "version", F.lit(STAMP))
    after = files_of(table.path)
    kept = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
    assert 0 < len(touched) <= 3 and len(kept) > 20 and all(after[f] == before[f] for f in kept)
    assert not any(f in after for f in before if f not in kept)
    want = upserts.upsert(target, updates, ["k1", "k2"], "version", F.lit(STAMP))
    assert sorted(map(str, table.read(spark).collect())) == sorted(map(str, want.select(*target.columns).collect()))
    assert table.upsert(updates.where("false"), "version") == [] and files_of(table.path) == after


def test_stored_upsert_reports_keys_held_twice(spark):
    table = upserts.StoredTarget(scratch_path(spark, "target"), ("id",), 4)
    table.write(spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "id int, v int"))
    assert as_set(table.duplicated_keys(table.read(spark))) == {(1, 2)}
    before = files_of(table.path)
    with pytest.raises(upserts.DuplicateKeys, match="1, 2"):
        table.upsert(spark.createDataFrame([(1, 5, 1)], "id int, v int, n int"), "n")
    assert files_of(table.path) == before


def test_unchanged_tables_are_not_joined(spark):
    rows = [(i, f"v{i}", float(i), None) for i in range(300)] + [(None, "n", 0.0, None)]
    before = spark.createDataFrame(rows, "id int, v string, x double, updated_at timestamp")
    same = before.repartition(5).orderBy(F.desc("v")).withColumn("updated_at", F.lit(STAMP))
    assert "Join" not in upserts.stamp_updated_at(before, same, "id", F.lit(STAMP))._jdf.queryExecution().executedPlan().toString()
    # Values that trade places, a row twice, a new and a removed row.
    after = before.where("id is null or id <> 9").withColumn("v", F.expr("case id when 1 then 'v2' when 2 then 'v1' else v end")).unionByName(before.where("id = 4"))
    after = after.unionByName(spark.createDataFrame([(999, "new", 1.0, None)], before.schema))
    assert 3 <= len(upserts.changed_buckets(before, after, "id", ["v", "x"])) <= 5
    out = upserts.stamp_updated_at(before, after, "id", F.lit(STAMP))
    assert out.count() == after.count() and {r["id"] for r in out.where("updated_at is not null").collect()} == {1, 2}


def test_stamps(spark):
    before = spark.createDataFrame([(1, "a", None), (2, None, None)], "id int, v string, updated_at timestamp")
    after = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", None)], before.schema)
    assert {r["id"] for r in upserts.stamp_updated_at(before, after, "id", F.lit(STAMP)).where("updated_at is not null").collect()} == {2}
    marked = spark.createDataFrame([(1, ["coop"]), (2, None), (3, ["min"])], "id int, deleted_by array<string>")
    out = upserts.append_deleted_by(marked, "coop", F.col("id") < 3)
    assert [r["deleted_by"] for r in out.orderBy("id").collect()] == [["coop"], ["coop"], ["min"]]
    edited = upserts.stamp_edited_by(spark.createDataFrame([(1, "x")], "id int, edited_by string"), "carto")
    assert edited.first()["edited_by"] == "carto"


def test_latest_clock(spark):
    d = [datetime(2020, 1, i) for i in range(1, 5)]
    df = spark.createDataFrame([(1, 7, d[0], d[3]), (2, 7, d[2], None), (3, 8, None, None), (4, 8, None, None)], "id int, k int, updated_at_coop timestamp, updated_at_ac timestamp")
    assert {r["id"] for r in latest_by(df, ["k"], ["updated_at_coop", "updated_at_ac"], "id").collect()} == {1, 3}


def test_only_the_first_of_a_key_keeps_its_value(spark):
    df = spark.createDataFrame([(1, "k", "a"), (2, "k", "b"), (3, None, "c"), (4, None, "d"), (5, "z", "e")], "id int, key string, v string")
    out = neutralise_rest(df, ["key"], [-F.col("id")], "id", ["v"], F.col("id") > 1)
    assert {r["id"]: r["v"] for r in out.collect()} == {1: "a", 2: "b", 3: None, 4: "d", 5: "e"}


# ---------------------------------------------------------------- joins
def test_insee_history(spark):
    history = spark.createDataFrame([("A", "B"), ("B", "C"), ("X", "Y"), ("X", "Z"), ("S", "S")], "code_insee_ancien string, code_insee_nouveau string")
    df = spark.createDataFrame([("A",), ("B",), ("X",), ("S",), ("Q",), (None,)], "code_insee string")
    got = as_set(joins.join_insee_history(df, history))
    assert got == {("A", "C", 1), ("B", "C", 1), ("X", "Y", 2), ("X", "Z", 2), ("S", "S", 1), ("Q", "Q", 1), (None, None, 1)}


def test_insee_history_has_no_longest_chain_and_ends_in_circles(spark):
    chain = [(f"{i:05d}", f"{i + 1:05d}") for i in range(1, 40)]
    circle = [("P", "Q"), ("Q", "R"), ("R", "P"), ("O", "P"), ("R", "E"), ("U", "V"), ("V", "U"), (None, "A"), ("Z", None)]
    history = spark.createDataFrame(chain + circle + circle, "code_insee_ancien string, code_insee_nouveau string")
    df = spark.createDataFrame([("00001",), ("00020",), ("00040",), ("P",), ("O",), ("U",), ("Z",)], "code_insee string")
    got = as_set(joins.join_insee_history(df, history))
    assert got == {("00001", "00040", 1), ("00020", "00040", 1), ("00040", "00040", 1), ("P", "E", 1), ("O", "E", 1), ("U", "U", 1), ("Z", "Z", 1)}
    assert {r[0] for r in joins.insee_history_circles(history).collect()} == {"O", "P", "Q", "R", "U", "V"}
    assert joins.join_insee_history(df, history.where("false")).where("code_insee_actuel <> code_insee").isEmpty()


def test_legacy_rows_find_their_entity(spark):
    legacy = spark.createDataFrame([(1, "S1"), (2, "S1"), (3, "S9"), (4, None)], "id int, siret string")
    entities = spark.createDataFrame([(70, 1, "S1"), (71, None, "S1"), (72, 4, None)], "id int, old_main_structure_id int, siret string")
    assert as_set(joins.join_legacy_mapping(legacy, entities)) == {(1, "S1", 70), (2, "S1", 70), (3, "S9", None), (4, None, 72)}


def test_update_writes_null_values_too(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    changes = spark.createDataFrame([(1, None), (9, "z")], "id int, v string")
    assert as_set(joins.update_from(df, changes, ["id"])) == {(1, None), (2, "b")}


# ---------------------------------------------------------------- reports
def test_fragility_is_weighted(spark):
    communes = spark.createDataFrame([("a", 100, "r"), ("b", 300, "r"), ("c", 50, "r"), ("d", 10, "s")], "code_insee string, population int, region string")
    ifn = spark.createDataFrame([("a", 2.0), ("b", 6.0), ("d", 1.5)], "code_insee string, score double")
    rows = {r["region"]: r for r in territory.fragilite_territoire(communes, ifn, "code_insee", ["region"]).collect()}
    assert (rows["r"]["score_moyen"], rows["r"]["population"], rows["r"]["nb_territoires"]) == (5.0, 400, 2)


def test_zones_count_sites_once(spark):
    sites = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "code_insee string")
    zones = spark.createDataFrame([("a", "QPV"), ("a", "QPV"), ("a", "FRR"), ("b", "QPV")], "code_insee string, type string")
    assert as_set(territory.structures_en_zone(sites, zones)) == {("FRR", 2, 1, 0.5, 1 / 3), ("QPV", 3, 2, 0.75, 2 / 3)}


def test_envelope_without_ceiling(spark):
    demande = spark.createDataFrame([(1, 5, 10.25), (1, 5, 20.5), (2, 6, 1.0)], "action_id int, enveloppe_financement_id int, subvention_demandee double")
    action = spark.createDataFrame([(1, 3), (2, 3)], "id int, feuille_de_route_id int")
    feuille = spark.createDataFrame([(3, "75")], "id int, gouvernance_departement_code string")
    enveloppe = spark.createDataFrame([(5, 1000.0), (6, 10.0)], "id int, montant double")
    plafond = spark.createDataFrame([("75", 5, 61.5)], "departement_code string, enveloppe_id int, plafond double")
    assert as_set(grants.consommation_enveloppe(demande, action, feuille, enveloppe, plafond)) == {
        ("75", 5, 2, 30.75, 1000.0, 61.5, 0.5), ("75", 6, 1, 1.0, 10.0, None, None),
    }


# ---------------------------------------------------------------- sources
def test_rows_that_do_not_fit_fail(spark, tmp_path):
    path = tmp_path / "postes.csv"
    path.write_text("id,etat\n1,vacant\nx,rendu\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_csv_source(spark, str(path), "id int, etat string").collect()


def test_cleaning(spark):
    df = spark.createDataFrame([(" a ", "", 1), (None, "  ", 2)], "Nom string, Rue string, n int")
    assert as_set(landing.ingest_clean(df, {"Nom": "nom", "Rue": "rue"})) == {("a", None, 1), (None, None, 2)}
    assert landing.ingest_clean(df, {"Nom": "nom"}, blanks_to_null=False).columns == ["nom", "Rue", "n"]


def test_keys_depend_on_the_row_alone(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "id int, v string")
    keys = [r["uuid"] for r in landing.ingest_surrogate_key(df, "coop", ["id", "v"]).collect()]
    again = [r["uuid"] for r in landing.ingest_surrogate_key(df.repartition(3).orderBy("id", F.col("v").desc_nulls_last()), "coop", ["id", "v"]).collect()]
    assert keys == again and len(set(keys)) == 3 and [len(x) for x in keys[0].split("-")] == [8, 4, 4, 4, 12]
    assert keys[0] != landing.ingest_surrogate_key(df, "other", ["id", "v"]).first()["uuid"]


def test_refresh_may_read_what_it_replaces(spark):
    path = scratch_path(spark, "refresh")
    with pytest.raises(FileNotFoundError):
        refresh.current_table(spark, path)
    assert refresh.refresh_table(spark, path, lambda: spark.range(3)).count() == 3
    held = refresh.current_table(spark, path)

    def doubled():
        return refresh.current_table(spark, path).unionByName(refresh.current_table(spark, path))

    assert refresh.refresh_table(spark, path, doubled).count() == 6 and refresh.current_table(spark, path).count() == 6
    with pytest.raises(Exception):
        refresh.refresh_table(spark, path, lambda: spark.range(3).select(F.raise_error(F.lit("stop"))))
    assert refresh.current_table(spark, path).count() == 6 and held.count() == 3
    # Columns may change with a version.
    assert refresh.refresh_table(spark, path, lambda: spark.range(2).select(F.lit("x").alias("a b"))).columns == ["a b"]


def test_readers_between_the_steps_of_a_refresh_see_one_whole_version(spark, monkeypatch):
    path = scratch_path(spark, "refresh")
    refresh.refresh_table(spark, path, lambda: spark.range(3))
    seen, point = [], refresh._point

    def observed(*args, **kw):
        seen.append(refresh.current_table(spark, path).count())  # the new folder is there, the pointer is not
        point(*args, **kw)
        seen.append(refresh.current_table(spark, path).count())

    def build():
        seen.append(refresh.current_table(spark, path).count())
        return spark.range(5)

    monkeypatch.setattr(refresh, "_point", observed)
    assert refresh.refresh_table(spark, path, build).count() == 5 and seen == [3, 3, 5]


def test_old_versions_are_kept_for_a_while(spark):
    path = scratch_path(spark, "refresh")
    held = refresh.refresh_table(spark, path, lambda: spark.range(3))
    refresh.refresh_table(spark, path, lambda: spark.range(4))
    assert refresh.expire_versions(spark, path) == [] and held.count() == 3
    old = refresh.expire_versions(spark, path, timedelta(0), datetime(2100, 1, 1))
    assert len(old) == 1 and spark.read.parquet(f"{path}/{old[0]}").count() == 0
    assert refresh.expire_versions(spark, path, timedelta(0), datetime(2100, 1, 1)) == []
    assert refresh.current_table(spark, path).count() == 4
    assert refresh.refresh_table(spark, path, lambda: spark.range(5)).count() == 5


def test_tables_are_found_by_name(spark):
    root = scratch_path(spark, "root")
    landing.land_raw(spark.range(2), "coop", "activites", root)
    assert spark.read.parquet(f"{root}/import/coop__activites").count() == 2
    spark.range(4).write.parquet(f"{root}/main/poste")
    assert tables.read_table(spark, root, "main.poste").count() == 4


def test_months_are_folders(spark):
    root = scratch_path(spark, "months")
    rows = spark.createDataFrame([(date(2024, 1, 5), 1), (date(2024, 1, 31), 2), (date(2024, 2, 1), 3)], "date date, duree int")
    path = tables.write_table(rows, root, "main.activites_coop", ["periode"])
    january = spark.read.parquet(path).where("periode = date'2024-01-01'")
    assert {r["duree"] for r in january.collect()} == {1, 2}
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(periode" in plan
    adresse = tables.with_generated_columns(spark.createDataFrame([("97411",)], "code_insee string"), "main.adresse")
    assert adresse.first()["departement"] == "974"


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_surrogate_keys_of_different_parts_differ(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, ""), ("", None), ("-", ""), ("1:a", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert len({r["uuid"] for r in landing.ingest_surrogate_key(df, "s", ["x", "y"]).collect()}) == len(rows)
