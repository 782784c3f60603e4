"""Trigram sets of a name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(name: Column) -> Column:
    """Distinct 3-grams of the lower-cased words, each padded with two blanks before and one after."""
    words = F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(
        padded,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))
        ),
    )
    return F.array_distinct(F.flatten(grams))


def trigram_code(gram: Column) -> Column:
    """The three code points of a trigram side by side in one number, 21 bits each."""
    first, second, third = (F.ascii(F.substring(gram, i, 1)).cast("bigint") for i in (1, 2, 3))
    return F.shiftleft(first, 42) + F.shiftleft(second, 21) + third


def trigram_similarity(common: Column, left_size: Column, right_size: Column) -> Column:
    """Shared trigrams over all trigrams of the two names."""
    return common / (left_size + right_size - common)
