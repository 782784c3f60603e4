"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax output.

Training is plain stochastic gradient descent in numpy on a bounded sample of labelled documents. The
output layer is linear in the averaged vectors, so for scoring every bucket's vector is reduced to one
number, its difference of class scores, and a document's score is the mean of these numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.llm.columns import held_out
from maillage.llm.text import Texts, batches, prefix_sums, sums_by_row, windows

FIT_ROWS = 4000  # bound of the labelled sample
BUCKETS = 1 << 17
DIM = 8
GRAMS = (3, 4)  # bytes of the character n-grams; they do not cross words
REPEATED = np.uint64(1)  # stands for all pairs of equal neighbouring words, the one word n-gram in use
EPOCHS = 4
RATE = 0.5
SEED = 7


def features(texts: Texts):
    """(buckets, offsets of each text's own) of all features: words, n-grams inside words, words said again at once."""
    starts, ends = texts.words()
    sums = prefix_sums(texts.data)
    parts = [(starts, windows(sums, starts, ends))]
    lengths = ends - starts
    offset = np.concatenate(([0], np.cumsum(lengths)))
    place = np.arange(offset[-1]) - np.repeat(offset[:-1] - starts, lengths)  # of every byte that is no white space
    left = np.repeat(ends, lengths) - place
    for n in GRAMS:
        at = place[left >= n]
        parts.append((at, windows(sums, at, at + n) + np.uint64(n)))
    word = parts[0][1]
    again = np.flatnonzero(word[1:] == word[:-1]) + 1
    first = np.zeros(len(word) + 1, bool)
    first[texts.rows_of(starts)] = True
    again = again[~first[again]]
    parts.append((starts[again], np.full(len(again), REPEATED)))
    for at, h in parts:
        yield (h & np.uint64(BUCKETS - 1)).astype(np.int64), texts.rows_of(at)


@dataclass(frozen=True)
class QualityModel:
    weight: np.ndarray  # float32 per bucket: score of class 1 less that of class 0
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        """Probability of class 1 per text."""
        out = []
        for texts in batches(column):
            total, count = np.zeros(texts.n), np.zeros(texts.n)
            for bucket, rows in features(texts):
                total += sums_by_row(self.weight[bucket], rows)
                count += np.diff(rows)
            out.append(1 / (1 + np.exp(-np.clip(self.bias + total / np.maximum(count, 1), -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def train(texts: list[str], labels: list[int], buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE) -> QualityModel:
    """Gradient descent, one document a step, the rate falling to zero.

    No rows, or rows of one class only, give a model without weights whose bias is the smoothed prior.
    """
    y = np.asarray(labels, np.int64)
    prior = float(np.log((np.sum(y == 1) + 1) / (np.sum(y == 0) + 1)))
    if not len(y) or len(set(labels)) < 2:
        return QualityModel(np.zeros(buckets, np.float32), prior)
    documents = []
    for text in texts:
        found = [b for batch in batches(pa.array([text], pa.string())) for b, _ in features(batch)]
        documents.append(np.unique(np.concatenate(found), return_counts=True))
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim))
    out = np.zeros((dim, 2))
    bias = np.array([0.0, prior])
    steps, done = epochs * len(y), 0
    for _ in range(epochs):
        for k in rng.permutation(len(y)):
            lr = rate * (1 - done / steps)
            done += 1
            bucket, count = documents[k]
            if not len(bucket):
                continue
            share = count / count.sum()
            hidden = share @ vectors[bucket]
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[y[k]] -= 1
            back = out @ error
            out -= lr * np.outer(hidden, error)
            bias -= 0.1 * lr * error
            vectors[bucket] -= (lr * len(bucket)) ** 0.5 * 4 * share[:, None] * back
    return QualityModel((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Train on at most ``fit_rows`` labelled documents that are not held out: those with the smallest id hashes."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y")).where(F.col("_y").isin(0, 1))
    known = known.where(~held_out(F.col("_id"), 3, 1)).orderBy(F.xxhash64("_id"), "_id", "_y").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select("_id", "_y", "text").collect()
    rows.sort(key=lambda r: (r["_id"], r["_y"], r["text"] or ""))
    return train([r["text"] or "" for r in rows], [r["_y"] for r in rows])


def quality_score(model: QualityModel, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(column), pa.float64())

    return score(text)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    A null text is empty; an empty text is scored by the bias. Repeated rows are scored once each.
    Without usable labels every score is 0.5. Other columns are not read.
    """
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
