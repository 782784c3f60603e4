"""Scalar expressions. Each takes and returns a ``Column``, so all stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SIRENE_FLOOR = "1900-01-01"
LABEL_BOTH, LABEL_V1, LABEL_V2 = "V1, V2", "V1", "V2"


def departement_of_insee(code: Column) -> Column:
    """Overseas codes (97x, 98x) keep three characters, all others two (2A and 2B included)."""
    return F.when(code.rlike("^9[78]"), F.left(code, F.lit(3))).otherwise(F.left(code, F.lit(2)))


def periode_of_date(day: Column) -> Column:
    """First day of the month."""
    return F.trunc(day, "month")


def zero_if_null(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast("bigint"))


def net_v2(montant: Column, bonification: Column) -> Column:
    """V2 grant without its bonus."""
    return zero_if_null(montant) - zero_if_null(bonification)


def label_enveloppes(v1: Column, v2: Column) -> Column:
    """Which envelopes paid, by the amounts that are present (a zero amount counts)."""
    return (
        F.when(v1.isNotNull() & v2.isNotNull(), F.lit(LABEL_BOTH))
        .when(v1.isNotNull(), F.lit(LABEL_V1))
        .when(v2.isNotNull(), F.lit(LABEL_V2))
    )


def greatest_floor(*days: Column, floor: str = SIRENE_FLOOR) -> Column:
    """Latest of two or more dates; an absent date counts as ``floor``, so it is never NULL."""
    return F.greatest(*[F.coalesce(d, F.lit(floor).cast("date")) for d in days])


def empty_json_to_null(json: Column) -> Column:
    """NULL for an object without keys, whatever its spacing."""
    return F.when(F.regexp_replace(json, r"\s", "") != "{}", json)


def array_union_clean(left: Column, right: Column) -> Column:
    """Distinct elements of both arrays without NULL and ''. A lone array is returned as it is."""
    both = F.array_distinct(F.filter(F.concat(left, right), lambda e: e.isNotNull() & (e != "")))
    return F.when(left.isNotNull() & right.isNotNull(), both).otherwise(F.coalesce(left, right))


def array_remainder(left: Column, right: Column) -> Column:
    """Elements of ``left`` that ``right`` lacks."""
    return F.array_except(left, right)


def array_slice_tail(values: Column) -> Column:
    """All elements but the first."""
    return F.slice(values, F.lit(2), F.size(values))


def nom_complet(prenom: Column, nom: Column) -> Column:
    """First and last name; NULL as soon as one of them is."""
    return F.concat(prenom, F.lit(" "), nom)


def normalise_activity_type(kind: Column, labels: Mapping[str, str] | None = None) -> Column:
    """Lower-case activity type -> PascalCase label; ``labels`` holds the exceptions."""
    label = F.regexp_replace(F.initcap(F.regexp_replace(F.lower(kind), "_", " ")), " ", "")
    if not labels:
        return label
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.element_at(known, F.lower(kind)), label)
