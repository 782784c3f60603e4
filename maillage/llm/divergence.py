"""Divergence of sources within a language, by sparse rows times a term-major index (Gustavson's method).

Rows are groups (a source in a language), columns are terms. The terms of a language are dealt to shards by
hash. In a shard each group's terms look up the groups that share them in a term-major index, and what they
contribute is added at once into a dense array with one place per peer, so no pair of postings is ever a row.
That array starts from the value of groups without any term; terms that only one of the two has are added
from the counts of equal shares, and where both have a term the scatter takes these baselines back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maillage.llm.arrow_words import coded_words, slices
from maillage.llm.columns import stored

SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCUMENTS = 3
TOP_TERMS = 200
# Postings (group, term) of a language in one shard: at least, and where a language has many sources, at most.
SHARD_ROWS, SHARD_ROWS_MOST = 1 << 17, 1 << 20
SCATTER = 1 << 20  # contributions computed at once


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    for part in parts:
        groups = pa.table([part.column("lang"), part.column("source")], ["lang", "source"])
        for lo, texts in slices(part.column("text")):
            mine = groups.slice(lo, len(texts))
            keys, group = _numbered(mine)
            codes, bounds, words = coded_words(texts, SEPARATORS)
            row = np.repeat(np.arange(len(texts)), np.diff(bounds))
            in_row, n = np.unique(row * max(len(words), 1) + codes, return_counts=True)
            row, term = np.divmod(in_row, max(len(words), 1))
            order = np.argsort(group[row] * max(len(words), 1) + term, kind="stable")
            key = (group[row] * max(len(words), 1) + term)[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            group_at, term_at = np.divmod(key[first], max(len(words), 1))
            totals = np.add.reduceat(n[order], first) if len(first) else np.zeros(0, np.int64)
            documents = np.diff(np.append(first, len(key)))
            taken = keys.take(pa.array(group_at))
            yield pa.RecordBatch.from_arrays([taken.column(0).combine_chunks(), taken.column(1).combine_chunks(), words.take(pa.array(term_at)), pa.array(totals), pa.array(documents)], names)
            # Groups occur even without a term.
            none = pa.nulls(len(keys), pa.string())
            zero = pa.array(np.zeros(len(keys), np.int64))
            yield pa.RecordBatch.from_arrays([keys.column(0).combine_chunks(), keys.column(1).combine_chunks(), none, zero, zero], names)


def _numbered(groups: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """(distinct groups, each row's number among them)."""
    lang, source = (groups.column(k).combine_chunks().dictionary_encode() for k in range(2))
    key = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(len(source.dictionary), 1) + source.indices.to_numpy(zero_copy_only=False)
    distinct, number = np.unique(key, return_inverse=True)
    a, b = np.divmod(distinct, max(len(source.dictionary), 1))
    return pa.table([lang.dictionary.take(pa.array(a)), source.dictionary.take(pa.array(b))], ["lang", "source"]), number


def share(count: Column, total: Column) -> Column:
    """1 + floor(1000000000 * (count + 1) / total) for count + 1 <= total, exact for totals below 9e15: three decimal digits at a time."""
    rest, out = count + 1, F.lit(0).cast("long")
    for _ in range(3):
        out = out * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return out + 1


def _f(p, q):
    return (p - q) * (p - q) // q


def _peer_sums(postings: pa.Table, peers: pa.Table) -> pa.Table:
    """Sums over a shard's terms of (p - q)^2 / q, floored each, for all ordered pairs of a language's groups."""
    order = np.argsort(peers.column("peer").to_numpy())
    sources = peers.column("source").combine_chunks().take(pa.array(order))
    p0 = peers.column("p0").to_numpy()[order]  # share of a term that the group lacks
    g = postings.column("number").to_numpy() - 1
    p = postings.column("p").to_numpy()
    terms = postings.column("term").combine_chunks().dictionary_encode()
    t = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_terms, n_groups = len(terms.dictionary), len(p0)
    index = np.argsort(t, kind="stable")  # term-major
    index_g, index_p = g[index], p[index]
    starts = np.searchsorted(t[index], np.arange(n_terms + 1))
    rows = np.argsort(g, kind="stable")  # group-major
    row_starts = np.searchsorted(g[rows], np.arange(n_groups + 1))
    # Equal shares of a group count together: (group, share, how many terms).
    by_share = np.lexsort((p, g))
    first = np.flatnonzero(np.diff(g[by_share], prepend=-1) | np.diff(p[by_share], prepend=-1)) if len(g) else np.zeros(0, np.int64)
    share_g, share_p, share_n = g[by_share][first], p[by_share][first], np.diff(np.append(first, len(g)))
    share_starts = np.searchsorted(share_g, np.arange(n_groups + 1))
    out_a, out_b, out_v = [], [], []
    for a in range(n_groups):
        nothing = _f(p0[a], p0)
        acc = n_terms * nothing
        # Only the peer has the term.
        np.add.at(acc, share_g, share_n * (_f(p0[a], share_p) - nothing[share_g]))
        # Only this group has the term.
        for k in range(share_starts[a], share_starts[a + 1]):
            acc += share_n[k] * (_f(share_p[k], p0) - nothing)
        # Both have it: scatter through the index, taking both baselines back.
        mine = rows[row_starts[a] : row_starts[a + 1]]
        size = starts[t[mine] + 1] - starts[t[mine]]
        ends = np.cumsum(size)
        lo = 0
        while lo < len(mine):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SCATTER, side="right")))
            some, n = mine[lo:hi], size[lo:hi]
            at = np.arange(n.sum()) + np.repeat(starts[t[some]] - (np.cumsum(n) - n), n)
            peer, q, own = index_g[at], index_p[at], np.repeat(p[some], n)
            np.add.at(acc, peer, _f(own, q) - _f(own, p0[peer]) - _f(p0[a], q) + nothing[peer])
            lo = hi
        others = np.delete(np.arange(n_groups), a)
        out_a.append(np.full(len(others), a))
        out_b.append(others)
        out_v.append(acc[others])
    a, b, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_a, out_b, out_v))
    lang = peers.column("lang").combine_chunks().take(pa.array(np.zeros(len(a), np.int64)))
    return pa.table([lang, sources.take(pa.array(a)), sources.take(pa.array(b)), pa.array(v)], ["lang", "source", "item", "value"])


def source_divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Per group (lang, source) of ``docs``: part, item, value, rank.

    Part ``pair`` has each other source of the language with the summed f against it over the language's kept
    terms (those in at least ``min_documents`` of its rows); 0 where none is kept. Part ``term`` has the
    ``top_terms`` terms that the group uses most beyond its language. f = floor((p - q)^2 / q) of smoothed shares
    out of a thousand million. Ranks count from 1, values descending, ties by the bytes of the item.

    A null lang, source or text counts as the empty string; an empty text leaves its group without terms, and the
    group still occurs. Repeated rows count as documents of their own. A language of one source has no pairs; an
    empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counts = stored(counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    by_term = Window.partitionBy("lang", "term")
    kept = counts.where(F.col("term").isNotNull()).select(
        "lang", "source", "term", "n", F.sum("docs").over(by_term).alias("documents"), F.sum("n").over(by_term).alias("lang_n"),
        (F.row_number().over(by_term.orderBy("source")) == 1).cast("long").alias("is_first"),
    )
    kept = stored(kept.where(F.col("documents") >= min_documents).drop("documents"), "divergence-postings")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    whole = kept.groupBy("lang").agg(F.sum("n").alias("whole"), F.sum("is_first").alias("terms"))
    groups = counts.where(F.col("term").isNull()).select("lang", "source").join(own, ["lang", "source"], "left").join(whole, "lang", "left").na.fill(0)
    groups = stored(groups.select(
        "lang", "source", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long").alias("number"),
        F.greatest(F.col("own") + F.col("terms"), F.lit(1)).alias("total"), F.greatest(F.col("whole") + F.col("terms"), F.lit(1)).alias("lang_total"),
    ), "divergence-groups")
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total")))

    n_groups = groups.agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first()["n"]
    n_shards = 1 + kept.count() // min(max(SHARD_ROWS, n_groups**2), SHARD_ROWS_MOST)
    shard = F.pmod(F.xxhash64("term"), F.lit(n_shards)).cast("long").alias("shard")
    postings = shares.select("lang", shard, "number", "term", "p").groupBy("lang", "shard")
    shards = F.explode(F.sequence(*(F.lit(n).cast("long") for n in (0, n_shards - 1)))).alias("shard")
    peers = groups.select(F.col("lang").alias("lang"), shards, F.col("number").alias("peer"), F.col("source").alias("source"), share(F.lit(0).cast("long"), F.col("total")).alias("p0")).groupBy("lang", "shard")
    sums = postings.cogroup(peers).applyInArrow(_peer_sums, "lang string, source string, item string, value long")
    best_first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(best_first))

    p, q = F.col("p"), F.col("q")
    above = shares.withColumn("q", share(F.col("lang_n"), F.col("lang_total"))).where(p > q)
    above = above.select("lang", "source", F.col("term").alias("item"), F.call_function("div", (p - q) * (p - q), q).alias("value"))
    terms = above.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top_terms)
    parts = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, x in (("pair", pairs), ("term", terms))]
    return parts[0].unionAll(parts[1])
