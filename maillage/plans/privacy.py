"""Access to personal data: reduced views, governed names, audit of query texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maillage import model
from maillage.plans.people import personne_enrichie
from maillage.sources.tables import read_table

# Schemas whose mention in a query text counts as use of a table. Fixed values.
SCHEMAS = ("admin", "main", "min", "reference", "llm", "import", "audit", "api", "auth", "dataviz", "pseudonymisation")
TABLE_PATTERN = r'\b(' + "|".join(SCHEMAS) + r')"?\s*\.\s*"?([a-z_][a-z0-9_]*)'
# What stands where a relation is named, and in a list of relations after it.
_NAME = r"[^\s,();.]+(?:\s*\.\s*[^\s,();.]+)*"
_OPEN = r"[\s(]*(?:(?:only|lateral)\b[\s(]*)*"
_NAMES_AT = r"\b(?:from|join|into|update|table)\b"
RELATIONS_PATTERN = rf"{_NAMES_AT}{_OPEN}{_NAME}(?:(?:[\s)]+(?:as\s+)?[^\s,();.]+)?[\s)]*,{_OPEN}{_NAME})*"
RELATION_PATTERN = rf"^\s*(?:{_NAMES_AT})?{_OPEN}({_NAME})"
CLAUSES_PATTERN = r"\b(?:select|where|group|order|having|limit|union|except|intersect|window|set|values|returning)\b"
# `name as (`, as the parts of a WITH are written.
PARTS_PATTERN = r"([a-z_][a-z0-9_]*)\s+as\s*(?:materialized\s*)?\("
UNREADABLE = "?"
# A column is used as a word of its own: `nom` in `p.nom`, not in `nom_commune`.
COLUMN_PATTERN = r"[\p{L}\p{N}_]+"
ALLOWED_SCHEMAS = ("admin", "reference")


def redact_json_keys(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """Keep only listed top-level keys of a JSON object, values as they are; other text becomes NULL."""
    parsed = F.from_json(column, "map<string,variant>")
    kept = F.map_filter(parsed, lambda k, v: k.isin(*keep))
    return df.withColumn(column, F.to_json(kept))


def safe_view(name: str, df: DataFrame) -> DataFrame:
    """The reduced form of a protected table, e.g. ``llm.personne``: the documented columns that the table has, and no others.

    A column that is new, renamed or misspelt is not shown, whatever it holds. Columns are chosen before the scan is
    planned, so the others are never read.
    """
    shown = set(model.SHOWN[name].split())
    view = df.select(*[F.col(f"`{c}`") for c in df.columns if c in shown])
    return redact_json_keys(view, "contact", model.ORG_CONTACT_KEYS) if name == "llm.structure_administrative" and "contact" in view.columns else view


def strip_identifiers(df: DataFrame) -> DataFrame:
    """Drop raw identifiers of persons, structures and external systems from an answer."""
    endings = tuple(f"_{c}" for c in model.IDENTIFIER_COLUMNS)
    return df.drop(*[c for c in df.columns if c in model.IDENTIFIER_COLUMNS or c.endswith(endings)])


def cap_rows(df: DataFrame, n: int = model.MAX_ROWS) -> DataFrame:
    return df.limit(n)


def is_allowed(table: str) -> bool:
    """Allowed by an include pattern and not excluded by name."""
    schema = table.split(".", 1)[0]
    included = table in model.INCLUDE_PATTERNS or f"{schema}.*" in model.INCLUDE_PATTERNS
    return included and table not in model.EXCLUDED


def governed_catalog(
    spark: SparkSession, root: str, tables: Sequence[str], safe_sources: Mapping[str, str] | None = None
) -> list[str]:
    """Register as ``schema__table`` views those of ``tables`` that may be read, and the safe views.

    ``safe_sources`` maps a safe view to the table it reduces. Anything else stays
    unknown to the session, so a query that names it does not pass analysis.
    """
    views = {}
    for table in tables:
        if is_allowed(table) and not table.startswith("llm."):
            views[table] = read_table(spark, root, table)
    for view, source in (safe_sources or {}).items():
        if view not in model.SAFE_VIEWS:
            raise ValueError(f"not a safe view: {view}")
        if view == "llm.personne_enrichie":
            df = personne_enrichie(
                read_table(spark, root, source), read_table(spark, root, "main.personne_affectations_emploi")
            )
        else:
            df = read_table(spark, root, source)
        views[view] = safe_view(view, df)
    for table, df in views.items():
        df.createOrReplaceTempView(table.replace(".", "__"))
    return sorted(views)


def policy_table(spark: SparkSession) -> DataFrame:
    """(table_name, tier) of every table refused by name."""
    rows = [(t, tier) for tier, names in ((1, model.TIER_1), (2, model.TIER_2), (3, model.TIER_3)) for t in names]
    rows += [(t, 0) for t in model.TECHNICAL]
    return spark.createDataFrame(rows, "table_name string, tier int")


def _relations(text: Column) -> Column:
    """Names at relation positions, quotes and spaces removed; names of WITH parts are left out unless a protected table has them."""
    # A nested query is no name, and what it selects no list of relations.
    lists = F.regexp_extract_all(F.regexp_replace(text, r"\b(?:select|with|values)\b", ";"), F.lit(RELATIONS_PATTERN), F.lit(0))
    items = F.flatten(F.transform(lists, lambda one: F.split(one, ",")))
    names = F.transform(items, lambda item: F.regexp_replace(F.regexp_extract(item, RELATION_PATTERN, 1), r'["`\s]', ""))
    bare = sorted({t.split(".")[-1].lower() for t in (*model.TIER_1, *model.TIER_2, *model.TIER_3, *model.TECHNICAL)})
    parts = F.filter(F.regexp_extract_all(text, F.lit(PARTS_PATTERN), F.lit(1)), lambda part: ~part.isin(*bare))
    return F.filter(names, lambda name: (name != "") & ~F.array_contains(parts, name))


def _unreadable(text: Column) -> Column:
    """Whether relations may stand where no pattern is sure to find them.

    That is so with comments, with a comma after a join, and with a comma after a closing
    bracket in a text that nests a query.
    """
    # What is selected is no relation: it is cut off from its mark up to FROM.
    marked = F.split(F.regexp_replace(text, r"\bselect\b", "limit ;"), CLAUSES_PATTERN)
    clauses = F.transform(marked, lambda c: F.regexp_replace(c, r"(?s)^\s*;.*?\bfrom\b", ""))
    after_join = F.exists(clauses, lambda c: c.rlike(r"(?s)\bjoin\b.*,"))
    after_nested = F.exists(F.slice(clauses, 2, F.size(clauses)), lambda c: c.rlike(r"\)[^(]*,"))
    nests = text.rlike(r"\(\s*(?:select|with|values)\b")
    return F.contains(text, F.lit("--")) | F.contains(text, F.lit("/*")) | after_join | (nests & after_nested)


def audit_queries(queries: DataFrame, id_col: str, text: str) -> DataFrame:
    """Which tables each query text uses, and whether the policy lets it pass.

    A query passes when it names at least one table and every table it names is
    allowed. Any schema-qualified name counts as use, wherever it stands (``tables``).
    Beyond those, whatever stands where a relation is named (after FROM, JOIN, INTO,
    UPDATE, TABLE or a comma that follows) must be on the list too, qualified or not,
    quoted or a path. The audit fails closed: a text in which relations may be hidden is
    refused as ``?``, a null text has no table and does not pass, and FROM within an
    expression, as in ``extract(year from d)``, counts as a relation. The policy is a
    fixed short list and is compared in place: no shuffle, whatever the number of queries.
    """
    lowered = F.lower(text)
    found = F.expr(f"regexp_extract_all(lower({text}), r'{TABLE_PATTERN}', 0)")
    tables = F.array_sort(F.array_distinct(F.transform(found, lambda t: F.regexp_replace(t, r'["\s]', ""))))
    include = "^(" + "|".join(p.replace(".", r"\.").replace("*", r".*") for p in model.INCLUDE_PATTERNS) + ")$"
    doubt = F.when(_unreadable(lowered), F.array(F.lit(UNREADABLE))).otherwise(F.array().cast("array<string>"))
    named = F.array_sort(F.array_union(F.concat("tables", "_relations"), "_doubt"))
    refused = F.filter(named, lambda t: ~t.rlike(include) | t.isin(*model.EXCLUDED))
    tiers = F.transform("refused", lambda t: F.when(t.isin(*model.TIER_1), 1).when(t.isin(*model.TIER_2), 2).when(t.isin(*model.TIER_3), 3))
    return (
        queries.select(id_col, tables.alias("tables"), _relations(lowered).alias("_relations"), doubt.alias("_doubt"))
        .withColumn("refused", refused)
        .select(
            id_col, "tables", "refused",
            F.array_min(F.array_compact(tiers)).alias("strictest_tier"),
            F.coalesce((F.size("tables") > 0) & (F.size("refused") == 0), F.lit(False)).alias("allowed"),
        )
    )


def audit_pii_columns(queries: DataFrame, id_col: str, text: str, names: Sequence[str] = model.PII_COLUMNS) -> DataFrame:
    """Forbidden column names that occur as words in each query text, and whether there is none."""
    words = F.expr(f"regexp_extract_all(lower({text}), r'{COLUMN_PATTERN}', 0)")
    hits = F.array_sort(F.array_intersect(F.array(*[F.lit(n) for n in names]), words))
    return queries.select(id_col, hits.alias("columns")).withColumn("allowed", F.size("columns") == 0)


# Up to so many needles each is looked for by itself; more are looked for together.
APART = 16
WINDOWS = (1, 2, 4, 8)  # characters
FILTER_BYTES = 1 << 19  # places of the filter on window hashes, a byte each


def scan_sensitive_text(
    docs: DataFrame, id_col: str, text: str, needles: Sequence[str] = model.SENSITIVE_NEEDLES
) -> DataFrame:
    """Documents that contain a needle, without regard to case, with the needles found, in the order given.

    Many needles are looked for in one pass over a text: every window of it is hashed and tested against a filter made
    from the beginnings of the needles, with three places set for each, and only the windows that pass (one in
    thousands, and the true ones) are held against the needles themselves, which are then confirmed in full. Windows are as long
    as the needles allow, up to 8 characters. All of it is one projection: no text is shuffled, and a document costs
    as much as it is long. A NULL text holds nothing; an empty needle is in every other text. Repeated needles are
    found once.
    """
    lowered = F.lower(text)
    sought = list(dict.fromkeys(n.lower() for n in needles))
    if len(sought) <= APART:
        hits = F.filter(F.array(*[F.lit(n) for n in sought]).cast("array<string>"), lambda n: F.contains(lowered, n))
        return docs.select(id_col, hits.alias("needles")).where("size(needles) > 0")
    found = [F.array(F.lit("")).cast("array<string>")] if "" in sought else []
    for k, size in enumerate(WINDOWS):
        longer = WINDOWS[k + 1] if k + 1 < len(WINDOWS) else None
        some = [n for n in sought if len(n) >= size and (longer is None or len(n) < longer)]
        if some:
            windows = F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))
            passed = F.filter(windows, _passes(docs, [n[:size] for n in some]))
            found.append(F.get(F.transform(F.array(passed), _confirmation(lowered, some, size)), F.lit(0)))
    if not found:
        return docs.select(id_col, F.array().cast("array<string>").alias("needles")).where("false")
    held = docs.where(F.col(text).isNotNull()).select(id_col, F.flatten(F.array(*found)).alias("_found")).where("size(_found) > 0")
    return held.select(id_col, F.array_intersect(_listed(sought), F.col("_found")).alias("needles"))


def _listed(words: Sequence[str]) -> Column:
    """A literal array of any length: one literal text, taken apart once when the query is planned."""
    mark = next(c for c in map(chr, range(0xE000, 0xF900)) if all(c not in w for w in words))  # for private use
    return F.split(F.lit(mark.join(words)), mark)


def _confirmation(lowered: Column, needles: Sequence[str], size: int):
    """From windows of a text to the needles that begin with one of them and are in the text."""

    def confirm(windows: Column) -> Column:
        held = F.filter(_listed(needles), lambda n: F.array_contains(windows, F.substring(n, 1, size)) & F.contains(lowered, n))
        return F.when(F.size(windows) == 0, F.array().cast("array<string>")).otherwise(held)

    return confirm


def _places(window: Column) -> list[Column]:
    """Three places in the filter that the hash of a window names."""
    return [F.pmod(F.xxhash64(F.lit(seed), window), F.lit(FILTER_BYTES)).cast("int") for seed in (1, 2, 3)]


def _passes(docs: DataFrame, beginnings: Sequence[str]):
    """Test of a window against a filter that all beginnings pass."""
    rows = docs.sparkSession.range(1).select(F.explode(_listed(sorted(set(beginnings)))).alias("w")).select(F.explode(F.array(*_places(F.col("w")))).alias("place"))
    filled = bytearray(FILTER_BYTES)
    for row in rows.distinct().collect():  # three places per needle, which the caller listed
        filled[row["place"]] = 1
    places, one = F.lit(bytes(filled)), F.lit(b"\x01")

    def test(window: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.substring(places, place + 1, F.lit(1)) == one for place in _places(window)])

    return test


def policy_coverage(expected: DataFrame, listed: DataFrame, name: str = "table_name") -> DataFrame:
    """Names that one side has and the other lacks: ``missing`` from the list, or ``unexpected`` in it."""
    want, have = expected.select(name).distinct(), listed.select(name).distinct()
    missing = want.join(have, name, "left_anti").withColumn("finding", F.lit("missing"))
    extra = have.join(want, name, "left_anti").withColumn("finding", F.lit("unexpected"))
    return missing.unionByName(extra)
