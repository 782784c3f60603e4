"""Importance resampling towards a target: hashed n-gram gains, and a draw by perturbed scores.

Words are found by Arrow kernels and become dictionary codes; a pair of neighbouring words is a pair of
shifted codes. Checksums are taken of the distinct words and of the distinct pairs of a slice, those of
pairs by joining the checksums of their words, which is linear algebra over bits and needs no string.
A document's weight is the floored mean of the gains of its features. Adding a Gumbel variate that the
id determines and keeping the highest scores draws without replacement in proportion to the weights.

The texts are read twice: once for the counts of 10,000 buckets, which is all that leaves the tasks, and
once for the weights. Only ids and scores are sorted, by ranges, so no task holds more than its range.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.llm.arrow_words import coded_words, segment_sums, slices
from maillage.llm.columns import stored

BUCKETS = 10_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEED = 7
MIN_WORDS = 20
PERCENT = 25


@lru_cache(4096)
def _shift_tables(size: int) -> np.ndarray:
    """What appending ``size`` bytes does to a crc32: its image per byte of the checksum and value of that byte."""
    zeros = bytes(size)
    base = zlib.crc32(zeros)
    bits = np.array([zlib.crc32(zeros, 1 << k) ^ base for k in range(32)], np.uint32).reshape(4, 8)
    on = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return np.bitwise_xor.reduce(np.where(on[None].astype(bool), bits[:, None, :], np.uint32(0)), axis=2)


def joined_crc32(first: np.ndarray, second: np.ndarray, second_size: np.ndarray) -> np.ndarray:
    """crc32 of joined strings from the crc32 of both parts and the bytes of the second."""
    if not len(first):
        return np.zeros(0, np.uint32)
    sizes, which = np.unique(second_size, return_inverse=True)
    tables = np.stack([_shift_tables(int(s)) for s in sizes])
    out = second.copy()
    for k in range(4):
        out ^= tables[which, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _buckets(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of some texts: bucket per distinct word, codes, bounds; bucket per distinct pair, their codes, bounds."""
    codes, bounds, words = coded_words(column, SEPARATORS)
    raw = words.cast(pa.binary()).to_pylist()
    crc = np.fromiter((zlib.crc32(w) for w in raw), np.uint32, len(raw))
    lead = np.fromiter((zlib.crc32(b" ", int(c)) for c in crc), np.uint32, len(raw))  # the word and the space after it
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    inner = np.ones(max(len(codes) - 1, 0), bool)  # a word and the next one are of one text
    cuts = bounds[1:-1]
    inner[cuts[(cuts > 0) & (cuts < len(codes))] - 1] = False
    left = np.flatnonzero(inner)
    pairs, pair_codes = np.unique(codes[left] * max(len(raw), 1) + codes[left + 1], return_inverse=True)
    a, b = np.divmod(pairs, max(len(raw), 1))
    pair_crc = joined_crc32(lead[a], crc[b], size[b])
    n_pairs = np.maximum(np.diff(bounds) - 1, 0)
    return (crc % buckets).astype(np.int64), codes, bounds, (pair_crc % buckets).astype(np.int64), pair_codes, np.concatenate(([0], np.cumsum(n_pairs)))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of column ``text``; buckets without a feature have no row.

    Each task adds up its own counts, so at most ``buckets`` rows a task are shuffled.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for part in parts:
            for _, texts in slices(part.column(0)):
                word, codes, _, pair, pair_codes, _ = _buckets(texts, buckets)
                n += np.bincount(word[codes], minlength=buckets) + np.bincount(pair[pair_codes], minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket: the floored 1000-fold log ratio of its smoothed shares in target and documents."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, texts in ((s, docs), (t, target)):
        for row in bucket_counts(texts, buckets).collect():  # a row per bucket
            counts[row["bucket"]] = row["n"]
    all_s, all_t = s.sum() + buckets, t.sum() + buckets
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


WEIGHED = pa.struct([("n_features", pa.int64()), ("weight", pa.int64())])


def text_weight(gains: np.ndarray, text: Column) -> Column:
    """Struct of a text's number of features and the floored mean of their gains (0 without a feature)."""

    @F.arrow_udf("n_features long, weight long")
    def weigh(column: pa.Array) -> pa.Array:
        sizes, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, texts in slices(column):
            word, codes, bounds, pair, pair_codes, pair_bounds = _buckets(texts, len(gains))
            n = np.diff(bounds) + np.diff(pair_bounds)
            total = segment_sums(gains[word][codes], bounds) + segment_sums(gains[pair][pair_codes], pair_bounds)
            sizes.append(n)
            weights.append(total // np.maximum(n, 1))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(sizes)), pa.array(np.concatenate(weights))], fields=list(WEIGHED))

    return weigh(text)


def perturbation(doc_id: Column, seed: int = SEED) -> Column:
    """Floored 1000-fold Gumbel variate of an id, from the first 32 bits of its seeded sha256; a null id counts as an empty one."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with their place (from 1) in a total order as ``rank``, without one task holding them all.

    Rows are dealt out by ranges and sorted there; what the driver gets is one count per range.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(spread.withColumn("_at", F.monotonically_increasing_id()), "importance-order")
    part = F.shiftright("_at", 33)  # the id is the partition's number and, in 33 bits, the place in it
    before, bases = 0, []
    for row in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        bases.append((row["part"], before))
        before += row["n"]
    known = F.broadcast(placed.sparkSession.createDataFrame(bases, "_part long, _before long"))  # a row per range
    rank = (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).alias("rank")
    return placed.join(known, part == F.col("_part")).select(*rows.columns, rank)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (null where not drawn).

    Of the N rows with at least ``min_words`` words the floor(percent * N / 100) highest scores are drawn, ties
    to the smaller doc_id, then in any order. Repeated rows count and are drawn once each. A null or empty text
    has no features and weight 0. An empty target gives every bucket the gain of no occurrences; an empty table
    gives an empty result. Other columns of both tables are not read.
    """
    gains = bucket_gains(docs, target, buckets)
    weighed = docs.select("doc_id", text_weight(gains, F.col("text")).alias("w")).select("doc_id", "w.n_features", "w.weight")
    scored = stored(weighed.withColumn("score", F.col("weight") + perturbation(F.col("doc_id"), seed)), "importance-scores")
    long_enough = F.col("n_features") >= 2 * min_words - 1  # n words have n - 1 pairs
    order = ranked(scored.where(long_enough).withColumn("_row", F.monotonically_increasing_id()), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("_row").asc())
    drawn = percent * order.count() // 100
    kept = order.select(*scored.columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return kept.unionAll(scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long")))
