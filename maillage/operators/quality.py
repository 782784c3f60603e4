"""Declared rules as jobs over whole tables. An empty result means the rule holds."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage import model
from maillage.operators.joins import join_unique


def _holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(True))


def dq_check(df: DataFrame, rule: Column | str) -> DataFrame:
    """Rows for which the rule is false; as in SQL, a rule that comes out NULL passes."""
    return df.where(~_holds(F.expr(rule) if isinstance(rule, str) else rule))


def domain_rule(column: str, allowed: Sequence[str]) -> Column:
    return F.col(column).isin(*allowed)


def dq_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return dq_check(df, domain_rule(column, allowed))


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def dq_length(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    return dq_check(df, reduce(lambda a, b: a & b, [_holds(F.length(c) <= n) for c, n in lengths.items()]))


def dq_unique(
    df: DataFrame, keys: Sequence[str], nulls_equal: bool = False, where: str | None = None
) -> DataFrame:
    """Keys held by several rows, with their number. ``keys`` may be SQL expressions.

    A key with a NULL part is exempt unless ``nulls_equal``. Counting combines on the
    map side, so a key that fills a third of the table is one row per task.
    """
    rows = df if where is None else df.where(where)
    keyed = rows.select(*[F.expr(k).alias(f"k{i + 1}") for i, k in enumerate(keys)])
    if not nulls_equal:
        keyed = keyed.dropna()
    return keyed.groupBy(*keyed.columns).agg(F.count("*").alias("nb")).where("nb > 1")


def dq_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are repeated, or have a NULL part."""
    keyed = df.select(*[F.col(k).alias(f"k{i + 1}") for i, k in enumerate(keys)])
    counted = keyed.groupBy(*keyed.columns).agg(F.count("*").alias("nb"))
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keyed.columns])
    return counted.where((F.col("nb") > 1) | has_null)


def dq_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose value no parent has; NULL passes."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def _columns_of(expression: str) -> set[str]:
    """Names that a declared SQL expression reads: what is neither quoted, a function nor a word of the language."""
    bare = re.sub(r"'[^']*'", " ", expression)
    return {w for w in re.findall(r"\b[a-z_][a-z0-9_]*\b(?!\s*\()", bare) if w not in _WORDS}


_WORDS = {"and", "or", "not", "is", "null", "in", "as", "int", "like", "rlike", "between", "timestamp", "date"}


def row_rules(table: str, columns: Sequence[str]) -> dict[str, str | None]:
    """All declared rules of one table that look at one row only, as SQL by name; None where a column of the rule is absent."""
    rules: dict[str, str | None] = {}
    for check in model.CHECKS:
        if check.table == table:
            rules[f"check:{check.name}"] = check.predicate if _columns_of(check.predicate) <= set(columns) else None
    for (owner, column), allowed in model.DOMAINS.items():
        if owner == table:
            rules[f"domain:{column}"] = f"{column} in ({', '.join(repr(v) for v in allowed)})" if column in columns else None
    for column in dict.fromkeys([*model.primary_key(table), *model.REQUIRED_COLUMNS.get(table, "").split()]):
        rules[f"not_null:{column}"] = f"{column} is not null" if column in columns else None
    for column, longest in model.MAX_LENGTHS.get(table, {}).items():
        rules[f"length:{column}"] = f"length({column}) <= {longest}" if column in columns else None
    return rules


def _key(values: Sequence[str]) -> str:
    """Values side by side as one text, each with its length before it; NULL is told from any text."""
    texts = [f"cast({v} as string)" for v in values]
    parts = [f"coalesce(concat(length({x}), ':', {x}), '-')" for x in texts]
    return f"concat({', '.join(parts)})"


# What a tagged row stands for: a broken row rule, a holder of a unique key, a reference, a value that can be referred to.
BROKEN, HOLDER, REFERENCE, KNOWN = "b", "u", "r", "k"


def dq_report(
    tables: Mapping[str, DataFrame],
    row_checks: Mapping[str, Mapping[str, str | None]] | None = None,
    uniques: Sequence[model.Unique] | None = None,
    foreign_keys: Sequence[model.ForeignKey] | None = None,
) -> DataFrame:
    """table_name, rule, violations: one row per declared rule of the given tables.

    Broken rows are counted for rules on one row, repeated keys for unique and primary keys, rows for references.
    A rule that a column of the table is missing for comes as ``missing_column:<rule>``, a reference to a table that
    is not given as ``missing_table:<rule>``, both with NULL violations.

    Each table is read once. A row becomes one small row per key or reference it takes part in, tagged with the
    rule, and one per broken rule; all tagged rows of all tables go through a single aggregate, which combines on
    the map side, so a key that fills a third of a table is one row per task.
    """
    names: list[tuple[str, str, bool]] = []  # table, rule, whether it is tested
    tagged: dict[str, list[str]] = {name: [] for name in tables}
    columns = {name: set(df.columns) for name, df in tables.items()}

    def declare(table: str, rule: str, missing: str | None = None) -> int:
        names.append((table, f"missing_{missing}:{rule}" if missing else rule, missing is None))
        return len(names) - 1

    def tag(table: str, rule: int, role: str, condition: str, key: str) -> None:
        tagged[table].append(f"if({condition}, named_struct('rule', {rule}, 'role', '{role}', 'key', {key}), null)")

    for name in tables:
        for rule, holds in (row_checks.get(name, {}) if row_checks is not None else row_rules(name, columns[name])).items():
            number = declare(name, rule, None if holds is not None else "column")
            if holds is not None:
                tag(name, number, BROKEN, f"not coalesce(({holds}), true)", "cast(null as string)")
    keys = [(u, f"unique:{', '.join(u.keys)}") for u in (model.UNIQUE_KEYS if uniques is None else uniques)]
    if uniques is None:
        keys += [(model.Unique(name, model.primary_key(name)), f"primary_key:{', '.join(model.primary_key(name))}") for name in tables]
    for u, rule in keys:
        if u.table in tables:
            absent = _columns_of(", ".join((*u.keys, u.where or ""))) - columns[u.table]
            number = declare(u.table, rule + (f" where {u.where}" if u.where else ""), "column" if absent else None)
            if not absent:
                concerned = [] if u.nulls_equal else [f"({k}) is not null" for k in u.keys]
                tag(u.table, number, HOLDER, " and ".join([*concerned, f"({u.where or 'true'})"]), _key(u.keys))
    for fk in model.FOREIGN_KEYS if foreign_keys is None else foreign_keys:
        if fk.child in tables:
            absent = fk.column not in columns[fk.child] or (fk.parent in tables and fk.parent_column not in columns[fk.parent])
            number = declare(fk.child, f"foreign_key:{fk.column}", "table" if fk.parent not in tables else "column" if absent else None)
            if fk.parent in tables and not absent:
                for table, column, role in ((fk.child, fk.column, REFERENCE), (fk.parent, fk.parent_column, KNOWN)):
                    tag(table, number, role, f"{column} is not null", _key([column]))

    role, n = F.col("role"), F.col("n")
    rows = [df.selectExpr(f"inline(array({', '.join(tagged[name])}))").where("rule is not null") for name, df in tables.items() if tagged[name]]
    declared = next(iter(tables.values())).sparkSession.createDataFrame(
        [(i, *entry) for i, entry in enumerate(names)], "number int, table_name string, rule string, tested boolean"
    )
    if not rows:
        return declared.select("table_name", "rule", F.lit(None).cast("long").alias("violations"))
    # A reference and the value it needs meet in one group; so do all holders of a key.
    per_key = reduce(DataFrame.unionAll, rows).groupBy(F.col("rule").alias("number"), "key").agg(
        F.count_if(role == BROKEN).alias("broken"), F.count_if(role == HOLDER).alias("holders"),
        F.count_if(role == REFERENCE).alias("references"), F.count_if(role == KNOWN).alias("known"),
    )
    found = F.col("broken") + (F.col("holders") > 1).cast("long") + F.when(F.col("known") == 0, F.col("references")).otherwise(0)
    counted = per_key.groupBy("number").agg(F.sum(found).alias("n"))
    return declared.join(counted, "number", "left").select("table_name", "rule", F.when(F.col("tested"), F.coalesce(n, F.lit(0))).alias("violations"))


def cascade_delete(child: DataFrame, column: str, gone: DataFrame, gone_column: str, on_delete: str) -> DataFrame:
    """What is left of ``child`` once the parents in ``gone`` are deleted.

    CASCADE removes the rows, SET NULL clears the reference. RESTRICT and NO ACTION
    forbid the deletion: the rows that stand in its way are returned.
    """
    keys = gone.select(F.col(gone_column).alias(column)).distinct()
    if on_delete == "CASCADE":
        return join_unique(child, keys, [column], "left_anti")
    if on_delete == "SET NULL":
        hit = join_unique(child, keys.withColumn("_gone", F.lit(True)), [column], "left")
        return hit.select(*[F.when(F.col("_gone").isNull(), F.col(c)).alias(c) if c == column else F.col(c) for c in child.columns])
    if on_delete in ("RESTRICT", "NO ACTION"):
        return join_unique(child, keys, [column], "left_semi")
    raise ValueError(f"unknown rule: {on_delete}")
