"""Row filters whose treatment of NULL is a decision of the data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def soft_delete_filter(df: DataFrame, marker: str = "deleted_at") -> DataFrame:
    """Rows not marked as deleted: an empty date, or a flag that is false or NULL."""
    if dict(df.dtypes)[marker] == "boolean":
        return df.where(~F.coalesce(F.col(marker), F.lit(False)))
    return df.where(F.col(marker).isNull())


def visible_only(df: DataFrame, flag: str = "is_visible") -> DataFrame:
    """Only an explicit FALSE hides a person."""
    return df.where(F.coalesce(F.col(flag), F.lit(True)))


def visible_on_map(df: DataFrame, flag: str = "visible_pour_cartographie_nationale") -> DataFrame:
    """Only an explicit TRUE shows a site."""
    return df.where(F.col(flag))


def active_links(df: DataFrame) -> DataFrame:
    return df.where(F.col("est_active"))


def false_or_null(flag: Column) -> Column:
    return ~F.coalesce(flag, F.lit(False))


def same_instant(left: Column, right: Column) -> Column:
    """Equal close dates, where both still open counts as equal."""
    return left.eqNullSafe(right)


def scope_filter(
    df: DataFrame,
    scope: str,
    value: object = None,
    departement: str = "departement_code",
    structure: str = "structure_id",
) -> DataFrame:
    """Restrict to a national, department or structure scope."""
    if scope == "national":
        return df
    columns = {"departement": departement, "structure": structure}
    if scope not in columns:
        raise ValueError(f"unknown scope: {scope}")
    return df.where(F.col(columns[scope]) == F.lit(value))
