"""Blocks of odd pages, and verdicts on repeated and odd URLs."""

import time
from collections import Counter

import pytest

from maillage.llm import html_blocks, url_rules
from maillage.llm.html_blocks import leaf_blocks


@pytest.mark.parametrize(("page", "blocks"), [
    ("<article><p>one</p><button>b<p>two</p><p>three</p></article>", ["one", "b", "two", "three"]),
    ("<p>E = <math><mi>m</mi><mo>c</mo></math> energy</p>", ["E = mc energy"]),
    ("<p>a <button class='x'>Share <b>it</b></button> b</p><select><option>x<option>y</select><p>z", ["a b", "z"]),
    ("<p>x <svg><title>t</title><text>q</text></svg> y</p><object><p>shown</p></object>", ["x y", "shown"]),
    ("<p>1 &lt; 2</p><script>if (a < b) {}</script><p>kept<!-- not", ["1 < 2", "kept"]),
    ("", []), ("   ", []), ("no tags & more", ["no tags & more"]),
])
def test_blocks_of_odd_pages(page, blocks):
    assert [b.text for b in leaf_blocks(page)] == blocks


@pytest.mark.parametrize("part", ["<a ", "<!", "<button>", "<svg ", '<a "', "<button><b>", "<object><i ", "<script ", "</"])
def test_broken_pages_are_read_once(part):
    start = time.process_time()
    leaf_blocks(part * 300_000)
    assert time.process_time() - start < 10  # once through; a scan per tag would take hours


def test_null_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (None, None, ""), (1, "u", None)], "page_id long, url string, html string")
    got = html_blocks.extract_blocks(pages).collect()
    assert Counter((r["page_id"], len(r["blocks"])) for r in got) == {(1, 0): 2, (None, 0): 1}
    assert html_blocks.extract_blocks(pages.where("false")).collect() == []


def test_repeated_and_odd_urls_keep_their_own_verdict(spark):
    urls = ["http://www.example.net/en/a", "http://www.example.net/fr", "https://X.ORG/fr/?q", None, "", "no host", "http://", "http://a.example.com/de/#x", "http://?x"]
    want = dict(zip(urls, ["allow", "block", "allow", "allow", "allow", "allow", "allow", "block", "allow"], strict=True))
    pages = spark.createDataFrame([(i if i % 7 else None, u, "clash") for i, u in enumerate(urls * 5)], "page_id long, url string, host string").repartition(4)
    got = url_rules.judge_urls(pages, url_rules.rule_table(spark)).collect()
    assert Counter((r["page_id"], r["verdict"]) for r in got) == Counter((i if i % 7 else None, want[u]) for i, u in enumerate(urls * 5))
    assert url_rules.judge_urls(pages.where("false"), url_rules.rule_table(spark)).collect() == []
    plan = url_rules.judge_urls(pages, url_rules.rule_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
