"""URL filters: host-suffix and path-prefix expressions against hashed rules. DataFrame functions only.

Every URL is expanded into expressions ``suffix of the host + prefix of the path``. Expressions and
rules meet on the first 32 bits of their SHA-256, the full digests then confirm the match, and of the
rules that fit the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maillage.llm.columns import ascii_lower
from maillage.operators.joins import join_unique

BLOCK, ALLOW = "block", "allow"
PREFIX_CHARS = 8  # hex digits of the digest on which the join runs
# (verdict, host, path): the production rules, fixed values.
RULES = ((BLOCK, "net", "/"), (ALLOW, "example.net", "/en/"), (BLOCK, "example.com", "/de/"), (ALLOW, "org", "/fr/"))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """Rules with digests: verdict, host, path, rule, digest, key. A rule without a host fits nothing and is left out."""
    df = spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, rule_host string, rule_path string")
    df = df.where(F.col("rule_host") != "").withColumn("rule_host", ascii_lower(F.col("rule_host")))
    rule = F.concat("rule_host", "rule_path")
    df = df.select("verdict", rule.alias("rule"), F.length("rule_host").alias("host_chars"), F.length("rule_path").alias("path_chars"), _digest(F.col("rule_host"), F.col("rule_path")).alias("digest"))
    # Two verdicts for one expression: block holds.
    return df.groupBy("rule", "host_chars", "path_chars", "digest").agg(F.max("verdict").alias("verdict")).withColumn("key", F.substring("digest", 1, PREFIX_CHARS))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)  # no host or path has a line break before the hash that could shift the parts


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """Per row: id, host, path, rule that decides (null: none) and verdict (without a rule: ``default``).

    Nulls and texts without ``://`` have an empty host and path and fit no rule. Repeated rows are
    given the verdict of their URL, which is found once. Rules fit a host and all its subdomains if the path begins with the rule's path;
    the longest rule wins, of equal lengths that with the longer host. An empty rule table fits nothing.
    Only path prefixes of lengths that some rule has are made: the number of lengths is bounded by the
    longest rule path, not by the number of rules or pages. The hash join is Spark's choice: a small
    rule table is broadcast below the session's threshold, a large one is shuffled on the hash prefix,
    where adaptive execution splits keys such as a very common suffix.
    """
    lengths = sorted(r[0] for r in rules.select("path_chars").distinct().collect())
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    base = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    places = base.where(F.col("host") != "").select("host", "path").distinct()  # an URL is judged once, however often it occurs
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(
        F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)) if lengths else F.array().cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    expressions = places.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    expressions = expressions.select("host", "path", "suffix", F.explode("prefixes").alias("prefix")).withColumn("expr_digest", _digest(F.col("suffix"), F.col("prefix")))
    hits = expressions.withColumn("key", F.substring("expr_digest", 1, PREFIX_CHARS)).join(rules, "key").where(F.col("expr_digest") == F.col("digest"))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "host_chars", "verdict", "rule")).alias("best"))
    return join_unique(base, best, ["host", "path"], "left").select(
        id_col, "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")
    )
