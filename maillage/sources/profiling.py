"""Column profiles, refused for tables whose content is protected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from maillage import model


class ProfilingRefused(PermissionError):
    """The table holds personal data; its values must not be summarised."""


def _holds(kind: DataType, *kinds: str) -> bool:
    """Whether a type is one of ``kinds``, or has one inside."""
    if kind.typeName() in kinds:
        return True
    inner = [f.dataType for f in kind.fields] if isinstance(kind, StructType) else [kind.elementType] if isinstance(kind, ArrayType) else []
    return any(_holds(k, *kinds) for k in inner)


def _text(column: Column, kind: DataType) -> Column:
    """A text that is equal for equal values."""
    if kind.typeName() == "map" and not _holds(kind.keyType, "map", "variant") and not _holds(kind.valueType, "map", "variant"):
        return F.to_json(F.array_sort(F.map_entries(column)))
    if kind.typeName() == "binary":
        return F.hex(column)
    return F.to_json(column) if _holds(kind, "map", "variant", "struct", "array") else column.cast("string")


def profile_parts(df: DataFrame, table: str, part: str = "") -> DataFrame:
    """One row per column of a part of a table, for storing: counts, least and greatest value, and a sketch of the distinct values.

    One pass over the part. Profiles of parts are added up by ``merge_profiles``; a part that is added to the table
    needs a profile of its own only. Columns of any type are profiled. Values of plain types are compared as such,
    binary ones by their bytes, arrays and structs by their text as JSON; maps and variants have no least value.
    """
    if model.tier_of(table) is not None:
        raise ProfilingRefused(table)
    measures, rows = [F.count("*").alias("n")], []
    for i, field in enumerate(df.schema.fields):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        text = _text(column, kind)
        plain = not _holds(kind, "map", "variant", "struct", "array", "binary")
        sketched = column.cast("long") if kind.typeName() in ("byte", "short", "integer", "long") else text
        ordered = column if plain else F.lit(None).cast("string") if _holds(kind, "map", "variant") else text
        measures += [
            F.count(column).alias(f"c{i}"), F.hll_sketch_agg(sketched).alias(f"d{i}"),
            F.min(ordered).cast("string").alias(f"lo{i}"), F.max(ordered).cast("string").alias(f"hi{i}"),
        ]
        rows.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(field.name).alias("column_name"), F.lit(part).alias("part"),
            F.lit(kind.simpleString() if plain else "string").alias("compared_as"), F.col("n").alias("nb"), (F.col("n") - F.col(f"c{i}")).alias("nb_null"),
            F.col(f"d{i}").alias("sketch"), F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
        ))
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def merge_profiles(parts: DataFrame) -> DataFrame:
    """Profiles of whole tables from those of their parts: rows, NULLs, approximate distinct values, minimum and maximum per column.

    A few rows per column and part are read, no row of the tables.
    """
    kinds = sorted(r["compared_as"] for r in parts.select("compared_as").distinct().collect())  # a row per type

    def best(pick, value: str) -> Column:
        typed = [pick(F.when(F.col("compared_as") == k, F.col(value).cast(k))).cast("string") for k in kinds]
        return (F.coalesce(*typed) if typed else F.first(F.col(value))).alias(value)

    # Sketches are united with themselves, as the estimate from one alone and that from several differ slightly.
    twice = parts.withColumn("sketch", F.explode(F.array("sketch", "sketch")))
    return twice.groupBy("table_name", "column_name").agg(
        F.expr("sum(nb) div 2").alias("nb"), F.expr("sum(nb_null) div 2").alias("nb_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"), best(F.min, "min_value"), best(F.max, "max_value"),
    )


def profile_columns(df: DataFrame, table: str, done: DataFrame | None = None) -> DataFrame:
    """Rows, NULLs, approximate distinct values, minimum and maximum per column, in one pass.

    ``done(table_name, column_name)`` lists profiles that exist already and are not repeated.
    """
    if done is None:
        return merge_profiles(profile_parts(df, table))
    known = {r["column_name"] for r in done.where(F.col("table_name") == table).select("column_name").distinct().collect()}  # a row per column
    left = [c for c in df.columns if c not in known]
    return merge_profiles(profile_parts(df.select(*[F.col(f"`{c}`") for c in left]), table)) if left else merge_profiles(profile_parts(df, table)).where("false")
