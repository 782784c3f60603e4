"""Merge pairs -> one surviving id per group of pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage.operators.joins import join_unique
from maillage.session import cut


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for undirected ``edges(a, b)``; the root is the smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): in each
    step a node hands its larger (then its smaller) neighbours to the smallest one.
    Both are one aggregate and one join back, so a node with very many neighbours is
    combined on the map side and split in the join. The number of rounds grows with
    the logarithm of the longest chain. Each round is cut in the shared folder; only
    a count and a hash reach the driver.
    """
    current = cut(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = _fingerprint(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            join_unique(both.where("b > a"), lowest, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            join_unique(large, least, ["a"], "inner")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        current = cut(small)
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _pointers(pairs: DataFrame) -> DataFrame:
    """One row per absorbed id: its smallest winner other than itself, how many it has, and whether it is paired with itself."""
    other = F.col("winner_id") != F.col("loser_id")
    return pairs.groupBy(F.col("loser_id").alias("id")).agg(
        F.min(F.when(other, F.col("winner_id"))).alias("root_id"),
        (F.max(F.when(other, F.col("winner_id"))) > F.min(F.when(other, F.col("winner_id")))).alias("_several"),
        F.bool_or(~other).alias("_itself"),
    )


def _follow(pointers: DataFrame) -> DataFrame:
    """(id, root_id, circles): every pointer followed to its end by doubling.

    A round sends each id to where its target points, so after k rounds 2**k steps are
    made: the number of rounds is the logarithm of the longest chain. Who still moves
    after as many steps as there are ids leads into a circle. A root of very many ids is
    on the left of the join and can be split. Each round is cut; a count reaches the driver.
    """
    pointers = cut(pointers.where("root_id is not null").select("id", "root_id"))
    n, steps = pointers.count(), 1
    while True:
        ahead = pointers.select(F.col("id").alias("root_id"), F.col("root_id").alias("_next"))
        pointers = cut(
            join_unique(pointers, ahead, ["root_id"], "left")
            .select("id", F.coalesce("_next", "root_id").alias("root_id"), F.col("_next").isNotNull().alias("circles"))
        )
        if steps > n or pointers.where("circles").isEmpty():
            return pointers
        pointers, steps = pointers.select("id", "root_id"), steps * 2


def merge_pair_conflicts(pairs: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """(id, conflict) of every absorbed id whose survivor the pairs leave open.

    ``same_id``: it is to be absorbed by itself. ``two_winners``: several entities claim it.
    ``circle``: its winners (the smallest, where there are several) lead into a circle.
    ``absent_survivor``: its survivor is not an ``id`` of ``entities``, if those are given.
    """
    pointers = cut(_pointers(pairs))
    ends = _follow(pointers)
    found = [
        pointers.where("_itself").select("id", F.lit("same_id").alias("conflict")),
        pointers.where("_several").select("id", F.lit("two_winners").alias("conflict")),
        ends.where("circles").select("id", F.lit("circle").alias("conflict")),
    ]
    if entities is not None:
        known = entities.select(F.col("id").alias("root_id"))
        absent = ends.where("not circles").join(known, "root_id", "left_anti")
        found.append(absent.select("id", F.lit("absent_survivor").alias("conflict")))
    return reduce(DataFrame.unionByName, found)


def resolve_merge_pairs(pairs: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """(id, root_id) for every id that is absorbed; a <- b <- c sends both to a.

    Pairs in conflict fail the job, so no entity is absorbed that was not named as a loser
    of one survivor; ``merge_pair_conflicts`` lists them. The result is cut: a merge reads
    it once per table.
    """
    pointers = cut(_pointers(pairs))
    counts = pointers.agg(F.count_if("_itself").alias("itself"), F.count_if("_several").alias("several")).first()
    if counts["itself"]:
        raise ValueError(f"winner_id and loser_id must differ: {counts['itself']} pairs of equal ids")
    if counts["several"]:
        raise ValueError(f"{counts['several']} ids have two winners, see merge_pair_conflicts")
    ends = _follow(pointers)
    if not ends.where("circles").isEmpty():
        raise ValueError("pairs run in a circle, see merge_pair_conflicts")
    mapping = ends.select("id", "root_id")
    if entities is not None and not mapping.join(entities.select(F.col("id").alias("root_id")), "root_id", "left_anti").isEmpty():
        raise ValueError("a survivor is not in the table, see merge_pair_conflicts")
    return mapping


def remap_ids(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Point a reference at the surviving id; other values, and NULL, stay."""
    targets = mapping.select(F.col("id").alias(column), F.col("root_id").alias("_root"))
    joined = join_unique(df, targets, [column], "left")
    return joined.select(*[F.coalesce("_root", column).alias(c) if c == column else F.col(c) for c in df.columns])


def drop_losers(df: DataFrame, mapping: DataFrame, id_col: str = "id") -> DataFrame:
    """Remove the absorbed rows."""
    return df.join(mapping.select(F.col("id").alias(id_col)), id_col, "left_anti")


def remap_parent(df: DataFrame, column: str, old_to_new: DataFrame) -> DataFrame:
    """Children of an absorbed entity's external id follow it to the survivor's id.

    ``old_to_new(id, root_id)`` is explicit, so children of the survivor's replaced
    external id are caught as well.
    """
    return remap_ids(df, column, old_to_new)
