"""What the plans of the registered queries must and must not contain."""

import re

import pytest

from driver_checks import QUERIES

FOLDER = "/root/testdata/sf0.001"
# These write a table or run rounds before they return; their steps are planned elsewhere.
EAGER = re.compile("merge_p|merge_c|merge_links|resolve|remap_ids|drop_losers|dedupe_personne|read_|land_|refresh|governed|postes_synthese$|fuzzy")


@pytest.fixture(scope="module", autouse=True)
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not EAGER.search(n)))
def test_no_pairs_of_everything_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not EAGER.search(n)))
def test_windows_keep_one_row_per_key_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    if re.search(r"^\W*Window \[row_number", plan, re.M):
        assert "Partial" in plan and "WindowGroupLimit" in plan


def test_flagship_reads_only_what_it_needs(spark):
    plan = plan_of(spark, "mediateurs_par_structure")
    customer = re.search(r"FileScan parquet \[(.*?)\].*customer\.parquet", plan).group(1)
    assert "c_name" not in customer and "c_acctbal" not in customer
    assert "TakeOrderedAndProject" in plan


def test_one_scan_of_the_links_for_all_status_flags(spark):
    plan = plan_of(spark, "personne_enrichie")
    assert plan.count("orders.parquet") == 1


def test_collapsed_summary_scans_each_input_once_per_role(spark):
    plan = plan_of(spark, "postes_synthese_collapse")
    # Positions as such and as owners of grants, and contracts.
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 3


# The side that may hold a hot key must come straight from a shuffle, and so must the
# other one: only then can adaptive execution split the key.
HOT = (
    "dedupe_adresse", "dedupe_structure_siret", "keep_first_neutralise_rest", "agg_array_ordered", "delete_using", "cascade_set_null",
    "join_postal", "join_self_active_closed", "join_existence_flag", "filter_neq", "links_fold_pairs", "links_collapse_active_closed",
    "links_collision_null", "links_repoint_rest", "poste_par_structure", "join_legacy_mapping", "join_insee_history", "split_structure",
)


def joins_of(plan):
    """Per sort-merge join: whether both children are a sort of a shuffle."""
    lines = [re.match(r"^([\s:+|-]*)(.*)$", line).groups() for line in plan.split("\n") if line.strip()]
    for i, (indent, text) in enumerate(lines):
        if text.startswith("SortMergeJoin"):
            depth = len(indent)
            children = [j for j in range(i + 1, len(lines)) if len(lines[j][0]) == depth + 3]
            end = next((j for j in range(i + 1, len(lines)) if len(lines[j][0]) <= depth), len(lines))
            yield [lines[j][1].startswith("Sort [") and lines[j + 1][1].startswith("Exchange") for j in children if j < end]


@pytest.mark.parametrize("name", HOT)
def test_hot_keys_can_be_split(spark, name):
    plan = plan_of(spark, name)
    found = list(joins_of(plan[plan.index("\n") :]))
    assert found and all(len(both) == 2 and all(both) for both in found)


def test_whole_sorts_are_in_order_to_the_last_row(spark):
    from driver_checks import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["sort_nulls_last"](spark, folder).collect()
    assert len(rows) > 50
    assert rows == sorted(rows, key=lambda r: (r.date_fin is None, -r.date_fin.toordinal() if r.date_fin else 0, r.id))
    rows = QUERIES["sort_bool_expr"](spark, folder).collect()
    assert len(rows) > 50 and rows == sorted(rows, key=lambda r: (r.structure_id is not None, r.id))
