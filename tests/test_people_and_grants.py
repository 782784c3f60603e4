"""Hand-written rows for the traps of the two views."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from maillage import functions as fn
from maillage.operators import filters
from maillage.plans import grants, people

PERSON = "id int, is_mediateur boolean, is_coordinateur boolean"
LINK = "personne_id int, structure_administrative_id int, source string, est_active boolean"


@pytest.fixture(scope="module")
def enriched(spark):
    persons = spark.createDataFrame(
        [(1, None, True), (2, True, True), (3, False, False), (4, True, False), (5, True, None), (6, None, None)], PERSON
    )
    links = spark.createDataFrame(
        [
            (1, 8, "aidants-connect", True),
            (2, 8, "idposte", False),
            (3, 8, "idposte", True),
            (4, 9, "coop", True),
            (4, 4, "min", True),
            (4, 1, "coop", False),
            (5, None, "idposte", True),
        ],
        LINK,
    )
    return {r["id"]: r for r in people.personne_enrichie(persons, links).collect()}


def test_unknown_mediator_flag_counts_as_helper(enriched):
    row = enriched[1]
    assert row["type_accompagnateur"] == "aidant_numerique"
    assert row["est_actuellement_aidant_numerique_en_poste"] and not row["est_actuellement_mediateur_en_poste"]
    assert row["labellisation_aidant_connect"] and row["est_actuellement_coordo_actif"]


def test_closed_link_gives_nothing(enriched):
    row = enriched[2]
    flags = [v for k, v in row.asDict().items() if k.startswith("est_actuellement") or k == "labellisation_aidant_connect"]
    assert flags == [False] * 5 and row["structure_employeuse_id"] is None


def test_counsellor_need_not_be_mediator(enriched):
    assert enriched[3]["est_actuellement_conseiller_numerique"] and not enriched[3]["est_actuellement_mediateur_en_poste"]


def test_smallest_active_employer(enriched):
    assert enriched[4]["structure_employeuse_id"] == 4
    assert enriched[4]["est_actuellement_mediateur_en_poste"] and not enriched[4]["est_actuellement_coordo_actif"]


def test_employer_may_be_unknown(enriched):
    assert enriched[5]["est_actuellement_conseiller_numerique"] and enriched[5]["structure_employeuse_id"] is None


def test_person_without_links(enriched):
    assert enriched[6]["type_accompagnateur"] == "aidant_numerique" and not enriched[6]["labellisation_aidant_connect"]


def test_mediators_are_counted_per_employer_name(spark):
    persons = spark.createDataFrame([(i, True, False) for i in range(1, 8)], PERSON)
    links = spark.createDataFrame(
        [(1, 1, "coop", True), (2, 1, "coop", True), (3, 2, "idposte", True), (4, 3, "coop", True), (5, 9, "coop", True), (6, 3, "min", True)], LINK
    )
    # Two entities bear one name; entity 9 does not exist.
    structures = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "id int, denomination_sirene string")
    rows = people.mediateurs_par_structure(people.personne_enrichie(persons, links), structures).collect()
    assert [tuple(r) for r in rows] == [("A", 3), ("B", 1)]


# ---------------------------------------------------------------- positions
POSTE = (
    "id int, poste_conum_id int, structure_id int, personne_id int, etat string, typologie string, date_attribution date, created_at timestamp"
)
CONTRAT = "id int, personne_id int, structure_id int, date_fin date, date_rupture date"
AMOUNTS = (
    "montant_subvention_v1", "montant_subvention_v2", "montant_bonification_v2", "montant_versement_v1", "versement_1_v2", "versement_2_v2", "versement_3_v2",
)
ENDS = ("date_fin_convention_dgcl", "date_fin_convention_ditp", "date_fin_convention_dge")
SUBVENTION = "poste_id int, " + ", ".join(f"{a} bigint" for a in AMOUNTS) + ", " + ", ".join(f"{e} date" for e in ENDS)
D1, D2 = date(2020, 1, 1), date(2021, 1, 1)


def grant(poste, **values):
    return (poste, *[values.get(a) for a in AMOUNTS], *[values.get(e) for e in ENDS])


@pytest.fixture(scope="module")
def positions(spark):
    poste = spark.createDataFrame(
        [
            (1, 10, 1, 100, "occupe", "conum", D1, datetime(2020, 1, 1)),
            (2, 10, 1, 101, "rendu", "coordo", D2, datetime(2020, 1, 1)),
            (3, 11, None, 102, "vacant", "conum", D1, datetime(2020, 1, 1)),
            (4, 12, 2, 103, "vacant", None, D1, datetime(2020, 1, 1)),
            (5, 12, 2, 104, "occupe", "dns", D1, None),
            (6, 13, 3, 105, "occupe", "conum", None, datetime(2020, 1, 1)),
            (7, 13, 3, 105, "rendu", "conum", D1, datetime(2019, 1, 1)),
        ],
        POSTE,
    )
    contrat = spark.createDataFrame(
        [(1, 100, 1, D1, None), (2, 100, 1, None, None), (3, 100, 1, D2, D1), (4, 105, 3, D2, D1), (5, 102, None, D2, None)], CONTRAT
    )
    subvention = spark.createDataFrame(
        [
            grant(1, montant_subvention_v1=50, montant_subvention_v2=100, montant_bonification_v2=30, versement_1_v2=7, date_fin_convention_dge=D2),
            grant(2, montant_subvention_v1=5, montant_versement_v1=3, date_fin_convention_dgcl=D1),
            grant(3, montant_subvention_v1=99),
            grant(4, montant_bonification_v2=1),
        ],
        SUBVENTION,
    )
    return poste, contrat, subvention


def test_contract_in_force_comes_first(positions):
    chosen = {(r["poste_conum_id"], r["structure_id"]): r["id"] for r in grants.poste_par_structure(*positions[:2]).collect()}
    # 10: the older position has a contract in force. 12: an absent creation date is newest.
    # 13: broken contracts do not help, and an absent attribution is last.
    assert chosen == {(10, 1): 1, (11, None): 3, (12, 2): 5, (13, 3): 7}


def test_contracts(positions):
    assert [tuple(r) for r in grants.contrats_en_cours(*positions[:2]).collect()] == [(10, 1, 2)]
    assert sorted(tuple(r) for r in grants.dernier_contrat(*positions[:2]).collect()) == [(10, 1, D2), (13, 3, D2)]


def test_summary_repeats_grants_by_payments(positions):
    rows = grants.postes_synthese(*positions).where("poste_conum_id = 10").collect()
    assert len(rows) == 4
    seen = sorted((r["subvention_v1"], r["subvention_v2"], r["bonification_v2"], r["montant_subvention_cumule"], r["versement_cumule_v1"], r["versement_cumule_v2"]) for r in rows)
    assert seen == [(5, 0, 0, 5, 0, 7), (5, 0, 0, 5, 3, 0), (50, 70, 30, 150, 0, 7), (50, 70, 30, 150, 3, 0)]
    assert {r["nb_contrats_en_cours"] for r in rows} == {2} and {r["date_fin_contrat"] for r in rows} == {D2}
    assert {r["enveloppes"] for r in rows} == {"V1, V2", "V1"} and {r["bonification_v1"] for r in rows} == {0}


def test_equal_grants_are_not_lost(spark, positions):
    poste, contrat, _ = positions
    twice = spark.createDataFrame([grant(1, montant_subvention_v1=5), grant(1, montant_subvention_v1=5), grant(2, montant_subvention_v1=5)], SUBVENTION)
    assert grants.postes_synthese(poste, contrat, twice).where("poste_conum_id = 10").count() == 9


def test_summary_without_structure_has_no_money(positions):
    for collapse in (False, True):
        row = grants.postes_synthese(*positions, collapse=collapse).where("poste_conum_id = 11").first()
        assert row["structure_id"] is None and row["subvention_v1"] == 0 and row["enveloppes"] is None
        assert row["nb_contrats_en_cours"] == 0 and row["date_fin_contrat"] is None


def test_collapsed_summary(positions):
    rows = {r["poste_conum_id"]: r for r in grants.postes_synthese(*positions, collapse=True).collect()}
    assert len(rows) == 4
    row = rows[10]
    assert (row["subvention_v1"], row["subvention_v2"], row["montant_subvention_cumule"], row["montant_versement_cumule"]) == (55, 70, 155, 10)
    assert row["enveloppes"] == "V1, V2" and row["date_fin_convention"] == D2 and row["bonification"]
    assert rows[12]["bonification"] and rows[12]["subvention_v2"] == -1 and rows[12]["enveloppes"] is None
    assert rows[12]["est_coordinateur"] is False and rows[13]["montant_subvention_cumule"] == 0


# ---------------------------------------------------------------- expressions
def test_department_codes(spark):
    codes = spark.createDataFrame([("97411",), ("98735",), ("2A004",), ("75056",), (None,)], "c string")
    assert [r[0] for r in codes.select(fn.departement_of_insee(F.col("c"))).collect()] == ["974", "987", "2A", "75", None]


def test_arrays(spark):
    df = spark.createDataFrame(
        [(["a", "", "b"], ["b", None, "c"]), (["a", ""], None), (None, None), (["x"], ["x"])], "w array<string>, l array<string>"
    )
    out = [r[0] for r in df.select(F.array_sort(fn.array_union_clean(F.col("w"), F.col("l")))).collect()]
    assert out == [["a", "b", "c"], ["", "a"], None, ["x"]]


def test_dates_have_a_floor(spark):
    df = spark.createDataFrame([(None, None), (D1, None), (date(1850, 1, 1), date(1860, 1, 1))], "w date, l date")
    assert [r[0] for r in df.select(fn.greatest_floor(F.col("w"), F.col("l"))).collect()] == [date(1900, 1, 1), D1, date(1860, 1, 1)]


def test_visibility(spark):
    df = spark.createDataFrame([(1, None), (2, True), (3, False)], "id int, is_visible boolean")
    assert [r["id"] for r in filters.visible_only(df).collect()] == [1, 2]
    assert [r["id"] for r in filters.visible_on_map(df, "is_visible").collect()] == [2]
    assert [r["id"] for r in df.where(filters.false_or_null(F.col("is_visible"))).collect()] == [1, 3]
    assert [r["id"] for r in filters.soft_delete_filter(df, "is_visible").collect()] == [1, 3]


def test_scope(spark):
    df = spark.createDataFrame([("01", 1), ("02", 2)], "departement_code string, structure_id int")
    assert filters.scope_filter(df, "national").count() == 2
    assert filters.scope_filter(df, "departement", "02").first()["structure_id"] == 2
    with pytest.raises(ValueError):
        filters.scope_filter(df, "region", "1")


def test_full_name_needs_both(spark):
    df = spark.createDataFrame([("Ada", "L"), (None, "L")], "p string, n string")
    assert [r[0] for r in df.select(fn.nom_complet(F.col("p"), F.col("n"))).collect()] == ["Ada L", None]


def test_totals_of_the_fan_out_without_the_fan_out(spark):
    poste = spark.createDataFrame(
        [(1, 10, 5, 7, "occupe", "conum", date(2020, 1, 1), datetime(2020, 1, 1)), (2, 11, None, 8, "vacant", "conum", date(2020, 1, 1), None)],
        "id long, poste_conum_id long, structure_id long, personne_id long, etat string, typologie string, date_attribution date, created_at timestamp",
    )
    contrat = spark.createDataFrame([], "id long, personne_id long, structure_id long, date_fin date, date_rupture date")
    amounts = ["montant_subvention_v1", "montant_subvention_v2", "montant_bonification_v2", "montant_versement_v1", "versement_1_v2", "versement_2_v2", "versement_3_v2"]
    dates = ["date_fin_convention_dgcl", "date_fin_convention_ditp", "date_fin_convention_dge"]
    schema = "poste_id long, " + ", ".join(f"{a} long" for a in amounts) + ", " + ", ".join(f"{d} date" for d in dates)
    one = (1, 3, 10, 4, 1, 2, 0, None, None, None, date(2021, 1, 1))
    other = (1, None, 5, 0, 0, 1, 1, 1, None, date(2030, 1, 1), None)

    def totals(summary):
        found = summary.totals()
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
        return {c: int(v) for c, v in found.first().asDict().items()}

    many = spark.createDataFrame([one] * 2000 + [other] * 500, schema)
    got = totals(grants.postes_factorises(poste, contrat, many))
    assert got["nb_lignes"] == 2500 * 2500 + 1
    assert got["montant_subvention_cumule"] == 2500 * (2000 * 13 + 500 * 5) and got["versement_cumule_v2"] == 2500 * (2000 * 2 + 500 * 3)
    # On few grants the rows themselves say the same.
    few = spark.createDataFrame([one] * 3 + [other] * 2, schema)
    for summary in (grants.postes_factorises(poste, contrat, few), grants.postes_factorises(poste, contrat, few).ending_before("2022-01-01")):
        rows, got = summary.rows().collect(), totals(summary)
        assert got.pop("nb_lignes") == len(rows) and got == {c: sum(r[c] for r in rows) for c in got}
    assert len(rows) == 15 and {r["date_fin_convention"] for r in rows} == {date(2021, 1, 1)}
