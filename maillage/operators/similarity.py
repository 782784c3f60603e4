"""Pairs of similar names by trigram similarity."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.functions import trigram_code, trigram_similarity, trigrams
from maillage.operators.joins import join_unique
from maillage.session import cut

DEFAULT_THRESHOLD = "0.3"  # fixed value: usual trigram threshold of PostgreSQL
# Names of more trigrams are joined on single trigrams: the pairs of a prefix grow with its square.
LONGEST_PAIRED = 64
# Bounds of the length classes, by a rule: each about half as wide again as the one before.
CLASSES = [1, 2, 3]
while CLASSES[-1] < 1 << 30:
    CLASSES.append(CLASSES[-1] * 3 // 2)
KEY_BITS = 32  # of the second trigram's number in a key


def numbered_by_rarity(occurrences: DataFrame) -> DataFrame:
    """(gram, number): 0, 1, 2... from the rarest trigram on, without a gap."""
    ordered = cut(occurrences.groupBy("gram").agg(F.count("*").alias("df")).orderBy("df", "gram").select("gram"))
    ordered = ordered.select("gram", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    sizes = {r["part"]: r["count"] for r in ordered.groupBy("part").count().collect()}  # a row per partition
    first = [sum(n for q, n in sizes.items() if q < part) for part in range(max(sizes, default=0) + 1)]
    row = F.col("row").bitwiseAND(F.lit((1 << 33) - 1))  # within its partition
    return ordered.select("gram", (F.element_at(F.array(*[F.lit(n).cast("long") for n in first]), F.col("part") + 1) + row).cast("int").alias("number"))


def ranked_names(people: DataFrame, name: str) -> DataFrame:
    """Distinct lower-case names: nom, id, nb, numbers of its trigrams (grams) from the rarest on, and a bit vector of 128 bits."""
    names = people.where(F.col(name).isNotNull()).groupBy(F.lower(name).alias("nom")).agg(
        F.min("id").alias("id"), F.count("*").alias("nb")
    )
    occurrences = names.select("nom", "id", "nb", F.explode(F.transform(trigrams(F.col("nom")), trigram_code)).alias("gram"))
    place = F.pmod(F.col("number"), F.lit(128))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place % 64)
    # A name has as many trigrams as letters, so gathering those of one name is bounded.
    ranked = join_unique(occurrences, numbered_by_rarity(occurrences), ["gram"], "inner").groupBy("nom", "id", "nb").agg(
        F.array_sort(F.collect_list("number")).alias("grams"),
        *[F.bit_or(F.when(place.between(64 * k, 64 * k + 63), bit).otherwise(0)).alias(f"bits{k}") for k in range(2)],
    )
    return cut(ranked)


def _ceil(numerator: Column, t: Fraction) -> Column:
    """ceil(t * numerator), in whole numbers."""
    return F.floor((numerator * t.numerator + (t.denominator - 1)) / F.lit(t.denominator)).cast("int")


def name_keys(ranked: DataFrame, threshold: str = DEFAULT_THRESHOLD) -> DataFrame:
    """A row per name and key of it, with all that a match needs of the name: key, at, nom, id, nb, grams and bits.

    A key is the numbers of two rare trigrams side by side, or the number of one; ``at`` is the place of the last.
    """
    t = Fraction(threshold)
    of_both = t / (1 + t)  # a match shares at least this part of the two sizes added up
    n = F.size("grams")
    length_class = F.size(F.filter(F.array(*[F.lit(c) for c in CLASSES]), lambda c: c <= n))
    lengths = ranked.groupBy(length_class.alias("class")).agg(F.min(n).alias("least"), F.max(n).alias("most")).collect()  # at most a row per class
    counts = _ceil(n, t)  # the length of the shortest partner that counts
    nearest = F.least(n, *[F.when(F.lit(r["most"]) >= counts, F.greatest(F.lit(r["least"]), counts)) for r in lengths])
    shared = _ceil(n + nearest, of_both)
    beyond = min((max(r["least"], LONGEST_PAIRED + 1) for r in lengths if r["most"] > LONGEST_PAIRED), default=None)
    pairs = F.when(n <= LONGEST_PAIRED, n - F.greatest(shared, F.lit(2)) + 2).otherwise(0)
    singles = F.when((n > LONGEST_PAIRED) | (shared < 2), n - shared + 1)
    if beyond is not None:
        singles = singles.when(n * t.denominator >= beyond * t.numerator, n - _ceil(n + beyond, of_both) + 1)
    rows = ranked.select("*", pairs.alias("pairs"), singles.otherwise(0).alias("singles"))
    rows = rows.select("*", F.posexplode(F.slice("grams", F.lit(1), F.greatest("pairs", "singles"))).alias("at", "gram"))
    none = F.array().cast("array<int>")
    before = F.when(F.col("at") < F.col("pairs"), F.slice("grams", F.lit(1), F.col("at"))).otherwise(none)
    alone = F.when(F.col("at") < F.col("singles"), F.array(F.lit(-1))).otherwise(none)
    rows = rows.select("nom", "id", "nb", "grams", "bits0", "bits1", "at", "gram", F.explode(F.concat(before, alone)).alias("rarer"))
    return rows.select(_key(F.col("rarer"), F.col("gram")).alias("key"), "at", "nom", "id", "nb", "grams", "bits0", "bits1")


def _key(rarer: Column, gram: Column) -> Column:
    """Of two trigrams; ``rarer`` is -1 where one will do."""
    return F.shiftleft((rarer + 1).cast("long"), KEY_BITS) + gram


def fuzzy_name_pairs(people: DataFrame, name: str, threshold: str = DEFAULT_THRESHOLD) -> DataFrame:
    """Distinct lower-case names whose trigram similarity reaches ``threshold``.

    Exact, by prefix filtering (Chaudhuri et al. 2006) with keys of several tokens (Wang et al. 2012). A pair of
    similarity t shares at least o = t / (1 + t) of both sizes together. With the trigrams of each name sorted by
    rarity, the two rarest that both share are then among the first ``n - o + 2`` of each, so names are joined on
    pairs of rare trigrams. o depends on the partner's size; each name writes its keys once, for the shortest
    partner that counts and that is there. Where as little as one shared trigram could do, or names are long, a key is
    one trigram and the prefix one shorter.

    Names are many times fewer than the pairs they form, so nothing is shuffled but names with their keys: a key's row
    holds all trigrams, and a pair is judged where it meets. It is kept on the key of the rarest trigrams that both
    share and on no other, so no pair comes twice. What meets is thinned by whole numbers first: by sizes, by the
    places of the key in both names, which bound what can still be shared, and by bit vectors, as each bit that only
    one name has is a trigram the other lacks. Bearers of one name are counted (``nb_a``, ``nb_b``), not paired with
    each other. Names without a letter or digit have no trigrams and no pairs. The ranked names are cut, as lengths
    and keys read them; both sides of the join are the same rows, shuffled once, and a key that very many names share
    is split on both sides by adaptive execution.
    """
    t = Fraction(threshold)
    of_both = t / (1 + t)
    keys = name_keys(ranked_names(people, name), threshold)
    sides = {s: keys.select("key", *[F.col(c).alias(f"{c}_{s}") for c in keys.columns if c != "key"]) for s in ("x", "y")}
    n_x, n_y = F.size("grams_x"), F.size("grams_y")
    both, needed = n_x + n_y, (n_x + n_y) * of_both.numerator
    single = F.col("key") < F.lit(1 << KEY_BITS)
    common = F.array_intersect("grams_x", "grams_y")

    def shared_at_most(a: str, b: str) -> Column:
        lone = [F.bit_count(F.col(f"bits{k}_{a}").bitwiseAND(F.bitwise_not(f"bits{k}_{b}"))) for k in range(2)]
        return F.size(f"grams_{a}") - lone[0] - lone[1]

    conditions = [
        (n_x < n_y) | ((n_x == n_y) & (F.col("nom_x") < F.col("nom_y"))),
        n_x * t.denominator >= n_y * t.numerator,
        single == ((needed <= of_both.denominator) | (n_y > LONGEST_PAIRED)),
        (F.least(n_x - F.col("at_x"), n_y - F.col("at_y")) + F.when(single, 0).otherwise(1)) * of_both.denominator >= needed,
        F.least(shared_at_most("x", "y"), shared_at_most("y", "x")) * of_both.denominator >= needed,
        F.size(common) * of_both.denominator >= needed,
        F.col("key") == F.when(single, _key(F.lit(-1), common[0])).otherwise(_key(common[0], common[1])),
    ]
    out = sides["x"].join(sides["y"], "key")
    for condition in conditions:
        out = out.where(condition)
    first = F.col("nom_x") < F.col("nom_y")
    return out.withColumn("communs", F.size(common)).select(
        *[F.when(first, F.col(f"{c}_x")).otherwise(F.col(f"{c}_y")).alias(f"{c}_a") for c in ("nom", "id", "nb")],
        *[F.when(first, F.col(f"{c}_y")).otherwise(F.col(f"{c}_x")).alias(f"{c}_b") for c in ("nom", "id", "nb")],
        "communs",
        trigram_similarity(F.col("communs"), n_x, n_y).alias("similarite"),
    )
