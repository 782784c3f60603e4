"""Read-only access to relational tables, and the choice of tables that may be read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.functions import departement_of_insee, periode_of_date

# Derived columns per table: name -> (source column, rule).
GENERATED = {
    "main.adresse": {"departement": ("code_insee", departement_of_insee)},
    "main.activites_coop": {"periode": ("date", periode_of_date)},
}


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Table ``schema.name`` from ``root/schema/name`` (Parquet)."""
    schema, name = table.split(".", 1)
    return spark.read.parquet(f"{root.rstrip('/')}/{schema}/{name}")


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int, partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same from a live database, read in parallel ranges of a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(**{**(options or {}), "url": url, "dbtable": table})
        .options(partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions)
        .load()
    )


def with_generated_columns(df: DataFrame, table: str) -> DataFrame:
    """Add the columns the model derives from others, so that filters on them reach the files."""
    return df.withColumns({c: derive(F.col(source)) for c, (source, derive) in GENERATED.get(table, {}).items() if source in df.columns})


def write_table(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = ()) -> str:
    """Store ``schema.name`` with its generated columns; returns the path.

    Activities are best stored by ``periode``: a query on some months then opens only
    their folders. Rows are gathered by partition first, or every task would write a
    file to every folder; the rebalance splits a month that holds very many rows.
    """
    schema, name = table.split(".", 1)
    path = f"{root.rstrip('/')}/{schema}/{name}"
    out = with_generated_columns(df, table)
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def select_tables(inventory: DataFrame, include: Sequence[str], exclude: Sequence[str], name: str = "table_name") -> DataFrame:
    """Names matched by an include pattern (``admin.*``) and not excluded by name.

    The two lists are configuration, so they become a filter and cost no join.
    """
    patterns = ["^" + p.replace(".", r"\.").replace("*", ".*") + "$" for p in include]
    included = reduce(lambda a, b: a | b, [F.col(name).rlike(p) for p in patterns], F.lit(False))
    return inventory.where(included & ~F.col(name).isin(*exclude))


def catalog_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column, type, nullability and comment of each table, from the schemas alone."""
    rows = [
        (table, i + 1, f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment"))
        for table, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    schema = T.StructType([
        T.StructField("table_name", T.StringType()), T.StructField("position", T.IntegerType()),
        T.StructField("column_name", T.StringType()), T.StructField("data_type", T.StringType()),
        T.StructField("nullable", T.BooleanType()), T.StructField("comment", T.StringType()),
    ])
    return spark.createDataFrame(rows, schema)


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments, which travel with the schema."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in df.columns])
