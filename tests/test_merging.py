"""Merges, links and duplicates on hand-written rows and against plain Python."""

import itertools
import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from maillage.operators import components, dedupe, links, merging, similarity, spatial


def pairs_of(spark, rows):
    return spark.createDataFrame(rows, "winner_id int, loser_id int")


def mapping_of(spark, rows):
    return spark.createDataFrame(rows, "id int, root_id int")


def as_set(df):
    return {tuple(r) for r in df.collect()}


# ---------------------------------------------------------------- pairs
def test_chain(spark):
    assert as_set(components.resolve_merge_pairs(pairs_of(spark, [(1, 2), (2, 3)]))) == {(2, 1), (3, 1)}


def test_winner_need_not_be_the_smallest(spark):
    assert as_set(components.resolve_merge_pairs(pairs_of(spark, [(10, 5), (5, 7), (20, 21)]))) == {(5, 10), (7, 10), (21, 20)}


def test_equal_ids_fail(spark):
    with pytest.raises(Exception, match="must differ"):
        components.resolve_merge_pairs(pairs_of(spark, [(7, 7)])).collect()


@pytest.mark.parametrize("rows, reason", [([(1, 9), (2, 9)], "two winners"), ([(1, 2), (2, 1), (1, 3)], "circle"), ([(1, 2), (2, 3), (3, 4), (4, 2)], "two winners")])
def test_conflicts_are_refused(spark, rows, reason):
    with pytest.raises(ValueError, match=reason):
        components.resolve_merge_pairs(pairs_of(spark, rows))


def test_conflicts_are_listed(spark):
    pairs = pairs_of(spark, [(1, 9), (2, 9), (2, 9), (11, 12), (12, 11), (12, 13), (13, 14), (20, 21), (21, 22), (30, 30), (99, 40), (40, 41), (50, 51), (50, 51)])
    entities = spark.createDataFrame([(i,) for i in range(60)], "id int")
    assert as_set(components.merge_pair_conflicts(pairs, entities)) == {
        (9, "two_winners"), (11, "circle"), (12, "circle"), (13, "circle"), (14, "circle"), (30, "same_id"), (40, "absent_survivor"), (41, "absent_survivor"),
    }
    assert as_set(components.merge_pair_conflicts(pairs.where("winner_id < 0"), entities)) == set()
    with pytest.raises(ValueError, match="not in the table"):
        components.resolve_merge_pairs(pairs_of(spark, [(99, 40)]), entities)
    assert as_set(components.resolve_merge_pairs(pairs.where("winner_id < 0"))) == set()


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    got = as_set(components.resolve_merge_pairs(pairs_of(spark, chain + star)))
    assert got == {(i, 0) for i in range(1, 301)} | {(1000 + i, 1000) for i in range(1, 400)}


def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    parent = list(range(150))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {(x, find(x)) for a, b in edges if a != b for x in (a, b)}
    assert as_set(components.connected_components(spark.createDataFrame(edges, "a int, b int"))) == want


# ---------------------------------------------------------------- persons
PERSON = "id int, coop_id string, cn_pg_id int, is_mediateur boolean, contact string, nom string"


def merged_person(spark, *rows, mapping=((2, 1),)):
    df = spark.createDataFrame(list(rows), PERSON)
    out = merging.merge_personne_fields(df, mapping_of(spark, list(mapping)))
    return {r["id"]: r for r in out.collect()}


def test_survivor_keeps_its_values_and_fills_gaps(spark):
    out = merged_person(spark, (1, None, 5, None, "{}", "A"), (2, "X", 6, False, '{"a":1}', "B"), (3, "Y", None, None, None, "C"))
    assert set(out) == {1, 3}
    assert tuple(out[1]) == (1, "X", 5, False, '{"a":1}', "A")
    assert tuple(out[3]) == (3, "Y", None, None, None, "C")


def test_contact_without_keys_is_a_gap(spark):
    rows = [(1, None, None, None, " { } ", "A"), (2, None, None, None, None, "B")]
    assert merged_person(spark, *rows)[1]["contact"] is None
    rows[1] = (2, None, None, None, "{}", "B")
    assert merged_person(spark, *rows)[1]["contact"] == "{}"


def test_several_absorbed_count_in_order(spark):
    out = merged_person(
        spark, (5, None, None, None, None, "A"), (7, "late", 1, None, None, "C"), (6, None, 2, True, None, "B"), mapping=((7, 5), (6, 5))
    )
    assert tuple(out[5])[:4] == (5, "late", 2, True)


def test_person_links(spark):
    t = datetime(2020, 1, 1)
    rows = spark.createDataFrame(
        [
            (1, 1, 9, "emploi", None), (2, 2, 9, "emploi", None),  # repeats the survivor's
            (3, 2, 9, "emploi", t), (4, 3, 9, "emploi", t),  # repeat each other: person 2 keeps it
            (5, 2, None, "emploi", None), (6, 1, None, "emploi", None),  # no structure: never equal
            (7, 8, 9, "emploi", None), (8, 8, 9, "emploi", None),  # not part of any merge
        ],
        "id int, personne_id int, structure_id int, type string, suppression timestamp",
    )
    out = merging.merge_personne_links(rows, mapping_of(spark, [(2, 1), (3, 1)]))
    assert {r["id"]: r["personne_id"] for r in out.collect()} == {1: 1, 3: 1, 5: 1, 6: 1, 7: 8, 8: 8}


def test_no_absorbed_id_is_left(spark):
    person = spark.createDataFrame([(i, f"c{i}") for i in range(1, 7)], "id int, coop_id string")
    reference = spark.createDataFrame([(i, 1 + i % 6) for i in range(30)], "id int, personne_id int")
    coordination = spark.createDataFrame(
        [(i, 1 + i % 6, 1 + (i + 1) % 6, "old", "old") for i in range(12)],
        "id int, coordinateur_id int, mediateur_id int, coordinateur_coop_id string, mediateur_coop_id string",
    )
    mapping = components.resolve_merge_pairs(pairs_of(spark, [(1, 2), (2, 3), (5, 6)]))
    tables = {"personne": person, "contrat": reference, "poste": reference, "coordination_mediation": coordination}
    once = merging.merge_persons(tables, mapping)
    twice = merging.merge_persons(once, mapping)
    for name in tables:
        assert as_set(once[name]) == as_set(twice[name])
    assert {r["id"] for r in once["personne"].collect()} == {1, 4, 5}
    assert {r["personne_id"] for r in once["contrat"].collect()} == {1, 4, 5}
    row = once["coordination_mediation"].where("id = 1").first()  # 2 -> 1 and 3 -> 1
    assert tuple(row) == (1, 1, 1, "c1", "c1")


# ---------------------------------------------------------------- structures
def test_structure_ids_are_replaced(spark):
    df = spark.createDataFrame(
        [(1, "A", None, "w"), (2, "B", "x", None), (3, "C", None, None)],
        "id int, structure_coop_id string, structure_ac_id string, structure_cartographie_nationale_id string",
    )
    assert as_set(merging.merge_structure_ids(df, mapping_of(spark, [(2, 1)]))) == {(1, "B", "x", "w"), (3, "C", None, None)}


def test_structure_fields(spark):
    schema = "id int, nom string, siret string, source string, last_sirene_enrich_at date, typologies array<string>, services array<string>"
    d = date(2022, 1, 1)
    df = spark.createDataFrame(
        [
            (1, "W", None, "", None, ["a", "", "b"], None), (2, "L", "1", "coop", None, ["b", None, "c"], ["s"]),
            (3, "W3", "3", "carto", d, ["a", ""], ["own"]), (4, "L4", "4", "x", None, None, ["other"]),
            (5, "W5", None, "", None, None, None), (6, "L6", None, None, d, [None, "z", "z"], None),
            (7, "alone", None, "", None, ["q", ""], None),
        ],
        schema,
    )
    out = {r["id"]: r for r in merging.merge_structure_fields(df, mapping_of(spark, [(2, 1), (4, 3), (6, 5)])).collect()}
    assert sorted(out) == [1, 3, 5, 7]
    assert (out[1]["nom"], out[1]["siret"], out[1]["source"], out[1]["last_sirene_enrich_at"]) == ("W", "1", "coop", date(1900, 1, 1))
    assert sorted(out[1]["typologies"]) == ["a", "b", "c"] and out[1]["services"] == ["s"]
    assert out[3]["typologies"] == ["a", ""] and out[3]["services"] == ["own"] and out[3]["last_sirene_enrich_at"] == d
    assert out[5]["typologies"] == [None, "z", "z"] and out[5]["source"] is None
    assert out[7]["typologies"] == ["q", ""] and out[7]["last_sirene_enrich_at"] is None and out[7]["source"] == ""


def test_structure_rows_take_ids_and_fields_at_once(spark):
    df = spark.createDataFrame([(1, "c1", None, "P"), (2, "c2", "S2", "c1"), (3, "c3", "S3", "c2"), (4, None, None, "c3")], "id int, structure_coop_id string, siret string, structure_parente string")
    mapping = mapping_of(spark, [(2, 1)])
    assert as_set(merging.merge_structure_rows(df, mapping).select("id", "structure_coop_id", "siret")) == {(1, "c2", "S2"), (3, "c3", "S3"), (4, None, None)}
    links_ = spark.createDataFrame([(1, 7, 2, LIEU, "c2", "m", None), (2, 8, None, LIEU, "c2", None, None), (3, 9, 3, LIEU, "c3", "m", None)], LINK)
    posts = spark.createDataFrame([(1, 2), (2, 3), (3, None)], "id int, structure_id int")
    out = merging.merge_structures({"structure": df, "personne_affectations": links_, "poste": posts}, mapping)
    assert as_set(out["poste"]) == {(1, 1), (2, 3), (3, None)}
    assert {(r["id"], r["structure_id"]) for r in out["personne_affectations"].collect()} == {(1, 1), (2, 1), (3, 3)}
    # The survivor has the absorbed external id now, so children of either follow it.
    assert {r["id"]: r["structure_parente"] for r in out["structure"].collect()} == {1: "P", 3: "c2", 4: "c3"}


# ---------------------------------------------------------------- links
LINK = "id int, personne_id int, structure_id int, type string, structure_coop_id string, mediateur_coop_id string, suppression timestamp"
T1, T2 = datetime(2020, 1, 1), datetime(2021, 1, 1)
LIEU = "lieu_activite"


@pytest.fixture(scope="module")
def merge(spark):
    pairs = spark.createDataFrame([(1, 2, "s2"), (11, 12, None)], "winner_id int, loser_id int, loser_coop_id string")

    def run(step, *rows, **more):
        df = spark.createDataFrame(list(rows), LINK)
        return {r["id"]: tuple(r)[1:] for r in step(df, pairs, **more).collect()}

    run.pairs = pairs
    return run


def test_collision(merge):
    out = merge(
        links.links_collision_null,
        (1, 7, 1, LIEU, "s", "m", None), (2, 8, 2, LIEU, "s", "m", None),
        (3, 7, 1, LIEU, None, "m", T1), (4, 8, 2, LIEU, None, "m", T1),
        (5, 7, 1, LIEU, "s", "m", T2), (6, 7, 11, LIEU, "s", "m", None), (7, 7, 5, LIEU, "s", "m", None),
    )
    assert out[1][3:5] == (None, None) and out[3][3:5] == (None, None)
    assert all(out[i][3:5] == ("s", "m") for i in (2, 5, 6, 7))


def test_orphan_collision(merge):
    out = merge(
        links.links_orphan_collision_null,
        (1, 7, 1, LIEU, "w", None, None), (2, 9, None, LIEU, "s2", None, None), (3, 7, 1, LIEU, "w", "m", None), (4, 9, None, LIEU, "else", "m", None),
    )
    assert out[1][3:5] == (None, None) and out[3][3:5] == ("w", "m") and out[2][3] == "s2"


def test_fold(merge):
    out = merge(
        links.links_fold_pairs,
        (1, 7, 1, LIEU, None, "m", None), (2, 7, 2, LIEU, "l", "x", None), (3, 7, 2, LIEU, "l", None, T1), (4, 8, 2, LIEU, None, None, None),
    )
    assert set(out) == {1, 3, 4} and out[1] == (7, 1, LIEU, "l", "m", None)


def test_repoint(merge):
    out = merge(links.links_repoint_rest, (1, 7, 1, LIEU, None, None, None), (2, 7, 2, LIEU, None, None, None), (3, 7, 2, LIEU, None, None, T1), (4, 7, 12, LIEU, None, None, None))
    assert {i: r[1] for i, r in out.items()} == {1: 1, 2: 2, 3: 1, 4: 11}


def test_attach(merge):
    out = merge(
        links.links_attach_orphans,
        (1, 7, 1, LIEU, "s2", "m", None), (2, 7, None, LIEU, "s2", "m", None), (3, 7, None, LIEU, "s2", "n", None),
        (4, 8, None, LIEU, "s2", None, None), (5, 8, None, LIEU, "s9", None, None), (6, 8, None, LIEU, None, None, None),
    )
    assert {i: r[1] for i, r in out.items()} == {1: 1, 3: None, 4: 1, 5: None, 6: None}


def test_close_dates(spark, merge):
    rows = [
        (1, 7, 1, LIEU, "a", "b", None), (2, 7, 2, LIEU, None, None, T1), (3, 7, 2, LIEU, None, None, T2),
        (4, 8, 1, LIEU, "a", "m", None), (5, 8, 1, LIEU, None, None, T1), (6, 8, 2, LIEU, None, None, T1),
        (7, 9, 1, LIEU, "c", "d", None), (8, 9, 2, LIEU, None, None, T1), (9, 1, 77, LIEU, "c", "d", T1),
        (10, 5, 1, LIEU, None, None, None),
    ]
    closed = links.closed_of_losers(spark.createDataFrame(rows, LINK), merge.pairs)
    out = merge(links.links_keep_close_dates, *rows, closed=closed)
    assert out[1][5] == T2  # takes the latest date
    assert 4 not in out and out[5][3:] == ("a", "m", T1)  # folded into the closed row
    assert out[7][5] is None and out[10][5] is None  # blocked by row 9; no date to take


def test_collapse(merge):
    out = merge(
        links.links_collapse_active_closed,
        (1, 7, 1, LIEU, None, "m", T1), (2, 7, 1, LIEU, "s", "x", None), (3, 8, 1, LIEU, "s", None, None), (4, 7, 5, LIEU, None, None, T1), (5, 7, 5, LIEU, "s", None, None),
    )
    assert set(out) == {1, 3, 4, 5} and out[1][3:5] == ("s", "m") and out[4][3] is None


def test_guard(merge):
    out = merge(
        links.links_dedupe_guard,
        (9, 7, None, LIEU, "s", "m", None), (10, 7, 1, LIEU, "s", "m", None), (11, 8, 1, LIEU, "s", "m", None), (12, 8, 5, LIEU, "s", "m", None), (13, 8, 1, LIEU, "s", "m", T1),
    )
    assert {i: r[3] for i, r in out.items()} == {9: None, 10: "s", 11: None, 12: "s", 13: "s"}


def test_whole_merge(spark, merge):
    rng = random.Random(3)
    rows = [
        (i, rng.randrange(6), rng.choice([1, 1, 2, 2, 11, 12, 5, None]), rng.choice([LIEU, "structure_emploi"]), rng.choice(["s1", "s2", None]),
         rng.choice(["m", "n", None]), rng.choice([None, T1, T2]))
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, LINK).withColumn("updated_at", F.lit(None).cast("timestamp"))
    out = links.merge_links(df, merge.pairs, F.lit(T2))
    got = out.collect()
    assert len({r["id"] for r in got}) == len(got) <= 120
    before = {r[0]: r for r in rows}
    for r in got:
        same = tuple(r)[:7] == before[r["id"]]
        assert r["updated_at"] is None or not same or r["structure_id"] in (1, 11)
        if r["structure_id"] == 5:
            assert same and r["updated_at"] is None
    # Nothing of the loser is left where the winner had room, and no open row stands beside a closed one.
    slots = {(r["structure_id"], r["personne_id"], r["type"]): set() for r in got}
    for r in got:
        slots[(r["structure_id"], r["personne_id"], r["type"])].add(r["suppression"] is None)
    assert all(len(v) == 1 for k, v in slots.items() if k[0] in (1, 11))


# ---------------------------------------------------------------- duplicates and names
def test_address_key(spark):
    schema = "id int, code_postal string, nom_commune string, nom_voie string, numero_voie int, repetition string"
    df = spark.createDataFrame(
        [(3, "1", "A", None, None, None), (2, "1", "A", None, 0, ""), (1, "1", "A", "v", 0, ""), (4, "1", "A", None, None, "bis")], schema
    )
    assert as_set(dedupe.dedupe_adresse(df)) == {(3, 2)}


def test_shared_ids_link_persons(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "b"), (4, None, None), (9, 7, "z")], "id int, cn_pg_id int, coop_id string")
    assert as_set(dedupe.dedupe_personne_ids(df, ["cn_pg_id", "coop_id"])) == {(2, 1), (3, 1)}


def test_one_key_for_a_third_of_all_rows(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("siret"), F.lit(None).cast("string").alias("denomination_antenne"))
    out = dedupe.dedupe_structure_siret(df)
    assert out.count() == 999 and {r["kept_id"] for r in out.collect()} == {0}


def test_split(spark):
    df = spark.createDataFrame(
        [(1, "S", None, "n1"), (2, "S", None, "n2"), (3, None, "ant", "n3"), (4, None, None, "n4"), (5, "S", "ant", "n5")],
        "id int, siret string, denomination_antenne string, nom string",
    )
    sites, entities, bridge = dedupe.split_structure(df, ["nom"], ["nom"])
    assert sites.count() == 5 and as_set(entities.select("id", "nom")) == {(1, "n1"), (3, "n3"), (5, "n5")}
    assert as_set(bridge) == {(1, 1), (2, 1), (3, 3), (5, 5)}


def grams(name):
    words = "".join(c if c.isalnum() else " " for c in name.lower()).split()
    return {w[i : i + 3] for w in (f"  {x} " for x in words) for i in range(len(w) - 2)}


@pytest.mark.parametrize("threshold", ["0.3", "0.5", "0.75", "1"])
def test_similar_names_against_all_pairs(spark, threshold):
    rng = random.Random(11)
    first = ["Ana", "Anna", "Éloïse", "Eloise", "Jean", "Jeanne", "Jean-Paul"]
    names = [f"{rng.choice(first)} {''.join(rng.choice('abé') for _ in range(rng.randrange(1, 6)))}" for _ in range(140)] + ["x", "", "--", None]
    df = spark.createDataFrame(list(enumerate(names)), "id int, nom string")
    want = {}
    for a, b in itertools.combinations(sorted({n.lower() for n in names if n and grams(n)}), 2):
        x, y = grams(a), grams(b)
        if len(x & y) >= float(threshold) * len(x | y) - 1e-12:
            want[(a, b)] = round(len(x & y) / len(x | y), 9)
    got = {(min(r["nom_a"], r["nom_b"]), max(r["nom_a"], r["nom_b"])): round(r["similarite"], 9) for r in similarity.fuzzy_name_pairs(df, "nom", threshold).collect()}
    assert got == want


@pytest.mark.parametrize("threshold", ["0.1", "0.3", "0.6"])
def test_similar_names_of_all_lengths_against_all_pairs(spark, threshold):
    """One trigram to more than the longest that are joined on pairs of trigrams, with partners on both sides of that."""
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdef") for _ in range(rng.choice([1, 1, 2, 3, 9, 30, 62, 66, 110]))) for _ in range(50)]
    names = sorted({stem[: rng.randrange(1, len(stem) + 1)] + rng.choice(["", "x", " yz"]) for stem in stems for _ in range(4)} | set(stems) | {"a b c", "b", "a"})
    df = spark.createDataFrame(list(enumerate(names)), "id int, nom string")
    sets, want = {n: grams(n) for n in names}, set()
    assert max(map(len, sets.values())) > similarity.LONGEST_PAIRED
    for a, b in itertools.combinations(names, 2):
        if 10 * len(sets[a] & sets[b]) >= round(10 * float(threshold)) * len(sets[a] | sets[b]):
            want.add((a, b, len(sets[a] & sets[b])))
    got = [(r["nom_a"], r["nom_b"], r["communs"]) for r in similarity.fuzzy_name_pairs(df, "nom", threshold).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_pairs_of_similar_names_are_not_shuffled(spark):
    """Pairs grow with the square of the names: only rows of names are shuffled, and a pair is judged where it meets."""
    df = spark.createDataFrame([(k, f"nom {k}") for k in range(50)], "id int, nom string")
    plan = similarity.fuzzy_name_pairs(df, "nom")._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Join")]
    assert plan.count("Join") == 1 and "Exchange" not in above and "Aggregate" not in above


def test_bearers_of_one_name_are_counted(spark):
    df = spark.createDataFrame([(1, "Jean Martin"), (2, "JEAN martin"), (3, "Jean Martins"), (4, "Jean Martin")], "id int, nom string")
    rows = similarity.fuzzy_name_pairs(df, "nom").collect()
    assert [(r["nom_a"], r["nb_a"], r["id_a"], r["nom_b"], r["nb_b"]) for r in rows] == [("jean martin", 3, 1, "jean martins", 1)]


def test_import_warnings(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, nom string")
    out = dedupe.merge_import_warnings(df, {"nom": F.col("nom").isNotNull(), "court": F.length("nom") < 2})
    assert [r["import_warnings"] for r in out.collect()] == ['["nom"]', None]


def test_guard_keeps_survivors_apart(spark):
    schema = "id int, personne_id int, structure_id int, type string, structure_coop_id string, mediateur_coop_id string, suppression timestamp"
    rows = [
        (1, 1, 10, "t", "s", "m", None), (2, 1, 20, "t", "s", "m", None), (3, 1, 20, "t", "s", "m", None),  # equal keys of two survivors
        (4, 2, None, "t", "s", "m", None), (5, 2, None, "t", "free", "m", None), (6, 2, None, "t", "free", "m", None), (7, 2, 30, "t", "s", "m", None),
    ]
    pairs = spark.createDataFrame([(10, 11, "c11"), (20, 21, "c21")], "winner_id int, loser_id int, loser_coop_id string")
    got = {r["id"]: r["structure_coop_id"] for r in links.links_dedupe_guard(spark.createDataFrame(rows, schema), pairs).collect()}
    assert got == {1: "s", 2: "s", 3: None, 4: None, 5: "free", 6: None, 7: "s"}


# ---------------------------------------------------------------- points in zones
def test_zones_with_holes_and_parts(spark):
    def ring(*corners):
        return [{"lon": float(x), "lat": float(y)} for x, y in [*corners, corners[0]]]

    zones = spark.createDataFrame(
        [
            ("hole", [[ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((1, 1), (3, 1), (3, 3), (1, 3))]]),
            ("parts", [[ring((10, 10), (11, 10), (10, 11))], [ring((-1, -1), (0, -1), (0, 0), (-1, 0))]]),
            ("l", [[ring((0, 0), (5, 0), (5, 1), (1, 1), (1, 5), (0, 5))]]),
        ],
        "zone_id string, geom array<array<array<struct<lon double, lat double>>>>",
    )
    points = spark.createDataFrame(
        [(1, 2.0, 2.0), (2, 0.5, 0.5), (3, 3.5, 3.5), (4, 10.2, 10.2), (5, 10.9, 10.9), (6, -0.5, -0.5), (7, 4.5, 0.5), (8, 4.5, 4.5), (9, None, 1.0)],
        "id int, lon double, lat double",
    )
    want = {(2, "hole"), (2, "l"), (3, "hole"), (4, "parts"), (6, "parts"), (7, "l")}
    for cell in (0.3, 1.0, 100.0):
        assert as_set(spatial.join_point_in_polygon(points, zones, cell).select("id", "zone_id")) == want


def star(rng, n, x, y, size):
    """A closed ring of n vertices around a point, jagged and not convex."""
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    radii = [size * (0.6 + rng.uniform(0, min(0.4, 8 / n)) + 0.2 * math.sin(7 * a)) for a in angles]
    ring = [(x + r * math.cos(a), y + r * math.sin(a)) for a, r in zip(angles, radii, strict=True)]
    return [*ring, ring[0]]


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (a, b), (c, d) in itertools.pairwise(ring):
            if (b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a:
                odd = not odd
    return odd


def test_zones_of_many_vertices_against_every_edge(spark):
    rng = random.Random(3)
    zones = {
        # A large outline with a hole and an island in it, another polygon, and zones of any size around.
        "large": [[star(rng, 20_000, 0.3, 0.2, 1.0), star(rng, 3000, 0.3, 0.2, 0.25), star(rng, 7, 0.3, 0.2, 0.05)], [star(rng, 50, 3, 3, 0.3)]],
        "small": [[star(rng, 5, -0.5, 0.2, 0.02)]], "middle": [[star(rng, 300, 0.1, 0.1, 0.4)]], "box": [[[(0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.5), (0.0, 0.0)]]],
        "empty": [], "no ring": [[]], "point": [[[(1.0, 1.0)]]],
    }
    spots = [(rng.uniform(-1.5, 3.5), rng.uniform(-1.5, 3.5)) for _ in range(150)] + [(rng.uniform(-0.6, 0.6), rng.uniform(-0.6, 0.6)) for _ in range(100)]
    spots += zones["large"][0][0][:60:2] + [(x, y) for x in (0.0, 0.1, 0.5) for y in (0.0, 0.25, 0.5)] * 2  # on vertices, borders, repeated
    want = {(i, z) for i, (x, y) in enumerate(spots) for z, polygons in zones.items() if any(inside(x, y, rings) for rings in polygons)}
    geom = [(z, [[[{"lon": x, "lat": y} for x, y in ring] for ring in rings] for rings in polygons]) for z, polygons in zones.items()]
    table = spark.createDataFrame(geom, "zone_id string, geom array<array<array<struct<lon double, lat double>>>>")
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "id int, lon double, lat double")
    for cell in (0.2, 4.0):
        got = [(r["id"], r["zone_id"]) for r in spatial.join_point_in_polygon(points, table, cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        # Edges are copied to the few cells they pass, at every level, and the first level keeps those of crowded cells out.
        levels = spatial.zone_cells(table, cell)
        carried = sum(t.agg(F.coalesce(F.sum(F.when(F.col("edges").isNotNull(), F.size("edges"))), F.lit(0))).first()[0] for t in levels)
        assert len(levels) > 1 and carried < 3 * 23_400


def test_zones_of_one_geometry_are_covered_once(spark, monkeypatch):
    box = lambda x: [[[(x, 0.0), (x + 1.0, 0.0), (x + 1.0, 1.0), (x, 1.0), (x, 0.0)]]]
    table = spark.createDataFrame([(k, box(float(k % 2))) for k in range(40)] + [(40, None)], "zone_id long, geom array<array<array<struct<lon: double, lat: double>>>>")
    points = spark.createDataFrame([(0, 0.5, 0.5), (1, 1.5, 0.5), (2, 2.5, 0.5)], "id long, lon double, lat double")
    cover, covered = spatial.zone_cells, []
    monkeypatch.setattr(spatial, "zone_cells", lambda zones, cell: covered.append(zones.where("geom is not null").count()) or cover(zones, cell))
    got = [(r["id"], r["zone_id"]) for r in spatial.join_point_in_polygon(points, table, 0.3).collect()]
    assert sorted(got) == [(p, k) for p in range(2) for k in range(40) if k % 2 == p]
    assert covered == [2]
