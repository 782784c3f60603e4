"""Toxicity: a second-order factorization machine over hashed terms.

Score = bias + sum of the weights of the terms present + sum over pairs of terms of the inner product of
their factors. The pairs let two terms count together that are harmless alone. Terms are words in lower
case without other characters, and their first bytes, so that compounds share a term. Every hashed term
that ``MIN_DOCUMENTS`` sample texts hold has a weight and factors; none is left out for what it says alone.

The machine is trained in numpy on the sparse pairs of text and term, by quasi-Newton steps (L-BFGS) on the
penalised log-loss: first the weights alone, then all of it, with factors that start from the leading
interactions of the errors the weights leave. Penalties go from strong to weak, each from where the one
before ended, as long as the loss on a tenth of the sample kept apart falls. A weight is penalised the less the
more its term tells by itself, within bounds that keep every weight and all factors free to grow.
Where the sample is bounded, by label, the bias is brought back to the ratio of the labels among all usable
rows, so that scores and threshold mean the same at every size.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.llm.columns import held_out, stored
from maillage.llm.text import LOWER, Texts, batches, prefix_sums, windows

FIT_TOXIC, FIT_OTHER = 3000, 6000  # bounds of the labelled sample, by label
BUCKETS = 1 << 20
MIN_DOCUMENTS = 3  # of the sample, for a term to have a weight and factors
PREFIXES = (4, 5, 6, 7)  # bytes
FACTORS = 4
PENALTIES = (16.0, 4.0, 1.0, 0.25)  # on squared weights, after scaling; FACTOR_PENALTY times that on squared factors
FACTOR_PENALTY = 32.0
LEAST_TELLING = 0.5  # association, in standard deviations, that every term is taken to have at least
STEPS = 30  # for a penalty
MEMORY = 6  # pairs of change and gradient change that L-BFGS keeps
POWER_STEPS = 12  # of the orthogonal iteration that starts the factors
APART = 10  # one in APART texts judges penalties
SEED = 11

# Bytes that belong to terms: letters, digits and everything outside ASCII.
_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def terms(texts: Texts):
    """(bucket, row) of all terms: words, and beginnings of longer words."""
    data = LOWER[texts.data]
    starts, ends = texts.words(~_LETTER[data])
    row = np.repeat(np.arange(texts.n), np.diff(texts.rows_of(starts)))
    sums = prefix_sums(data)
    buckets, rows = [windows(sums, starts, ends)], [row]
    for n in PREFIXES:
        longer = ends - starts > n
        at = starts[longer]
        buckets.append(windows(sums, at, at + n) + np.uint64(n))
        rows.append(row[longer])
    return (np.concatenate(buckets) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(rows)


@dataclass(frozen=True)
class ToxicityModel:
    slot: np.ndarray  # int32 per bucket: place in weight and factors, -1 for terms without one
    weight: np.ndarray
    factors: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        out = []
        for texts in batches(column):
            bucket, row = terms(texts)
            slot = self.slot[bucket]
            known = slot >= 0
            size = max(len(self.weight), 1)
            row, slot = np.divmod(np.unique(row[known] * size + slot[known]), size)  # a term counts once in a text
            logit = Pairs(row, slot, texts.n, size).logits(self.bias, self.weight, self.factors)[0]
            out.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


@dataclass(frozen=True)
class Pairs:
    """Which terms are in which texts: one entry for each."""

    row: np.ndarray
    slot: np.ndarray
    rows: int
    slots: int

    def by_row(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, values[self.slot], self.rows)

    def by_slot(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.slot, values[self.row], self.slots)

    def of(self, chosen: np.ndarray) -> Pairs:
        """Those of some rows, which are numbered anew."""
        place = np.cumsum(chosen) - 1
        mine = chosen[self.row]
        return Pairs(place[self.row[mine]], self.slot[mine].astype(np.int64), int(chosen.sum()), self.slots)

    def logits(self, bias: float, weight: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logits, sum of the factors of each text's terms)."""
        if not len(weight):
            return np.full(self.rows, bias), np.zeros((self.rows, FACTORS))
        inner = np.stack([self.by_row(f) for f in factors.T], 1) if factors.any() else np.zeros((self.rows, factors.shape[1]))
        return bias + self.by_row(weight - 0.5 * (factors**2).sum(1)) + 0.5 * (inner**2).sum(1), inner

    def loss(self, params: np.ndarray, y: np.ndarray, paired: bool = False) -> tuple[float, np.ndarray]:
        """Log-loss and its gradient; ``params``: bias, weights, factors, the latter left as they are unless ``paired``."""
        bias, weight, factors = unpack(params)
        logit, inner = self.logits(bias, weight, factors)
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y
        grads = np.zeros_like(params)
        by_slot = self.by_slot(error)
        grads[0], grads[1 : 1 + self.slots] = error.sum(), by_slot
        if paired:
            grads[1 + self.slots :] = (np.stack([self.by_slot(error * i) for i in inner.T], 1) - factors * by_slot[:, None]).ravel()
        return float(np.logaddexp(0, np.where(y > 0, -logit, logit)).sum()), grads


def unpack(params: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    slots = (len(params) - 1) // (1 + FACTORS)
    return float(params[0]), params[1 : 1 + slots], params[1 + slots :].reshape(slots, FACTORS)


def descend(f, x: np.ndarray, steps: int) -> np.ndarray:
    """At most ``steps`` L-BFGS steps on ``f`` (value, gradient) from ``x``, each with a step halved until the value falls enough."""
    value, grad = f(x)
    changes: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        go, alphas = grad.copy(), []
        for s, t, st in reversed(changes):
            alphas.append((s @ go) / st)
            go -= alphas[-1] * t
        go *= changes[-1][2] / (changes[-1][1] @ changes[-1][1]) if changes else 1 / max(np.abs(grad).max(), 1e-12)
        for (s, t, st), alpha in zip(changes, reversed(alphas), strict=True):
            go += (alpha - (t @ go) / st) * s
        slope, length = float(grad @ go), 1.0
        if slope < 1e-9 * max(1.0, abs(value)):
            break
        while True:
            new = x - length * go
            new_value, new_grad = f(new)
            if new_value <= value - 1e-4 * length * slope or length < 1e-4:
                break
            length /= 2
        if new_value >= value:
            break
        s, t = new - x, new_grad - grad
        if s @ t > 1e-10 * (t @ t):
            changes = [*changes, (s, t, float(s @ t))][-MEMORY:]
        done = value - new_value < 1e-5 * abs(value)
        x, value, grad = new, new_value, new_grad
        if done:
            break
    return x


def interactions(pairs: Pairs, error: np.ndarray) -> np.ndarray:
    """Factors along the pairs of terms whose presence together the errors speak for most (orthogonal iteration).

    The directions of steepest growth of factors near zero: leading eigenvectors of -X' diag(error) X without its diagonal.
    """
    own = pairs.by_slot(error)
    shift = np.abs(error).max() * np.sqrt(np.bincount(pairs.slot, minlength=pairs.slots).max(initial=0))
    v = np.linalg.qr(np.random.default_rng(SEED).normal(size=(pairs.slots, FACTORS)))[0]
    for _ in range(POWER_STEPS):
        pulled = np.stack([pairs.by_slot(error * pairs.by_row(f)) for f in v.T], 1) - own[:, None] * v
        v = np.linalg.qr(shift * v - pulled)[0]
    return v


def _present(column: pa.Array):
    """(row, bucket) of the terms in each text, each once, for runs of texts."""
    for batch in batches(column):
        bucket, row = terms(batch)
        key = np.unique((row + batch.lo) * BUCKETS + bucket)
        yield key // BUCKETS, (key % BUCKETS).astype(np.int32)


def train(texts: list[str], labels: list[int], shares: tuple[float, float] = (1.0, 1.0)) -> ToxicityModel:
    """Fit bias, weights and factors of all terms in at least ``MIN_DOCUMENTS`` of ``texts``.

    ``shares``: how much of the toxic and of the other usable rows the sample holds. No rows, or rows of one
    class only, give a model without terms whose bias is the smoothed prior of all usable rows.
    """
    y = np.asarray(labels, np.float64)
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    slot = np.full(BUCKETS, -1, np.int32)
    if not len(y) or y.min() == y.max():
        prior = float(np.log((y.sum() / shares[0] + 1) / ((len(y) - y.sum()) / shares[1] + 1)))
        return ToxicityModel(slot, np.zeros(0), np.zeros((0, FACTORS)), prior)
    column = pa.array(texts, pa.large_string())
    seen = np.zeros(BUCKETS, np.int64)
    for _, bucket in _present(column):
        seen += np.bincount(bucket, minlength=BUCKETS)
    chosen = np.flatnonzero(seen >= MIN_DOCUMENTS)
    slot[chosen] = np.arange(len(chosen), dtype=np.int32)
    kept = [(row[slot[b] >= 0].astype(np.int32), slot[b][slot[b] >= 0]) for row, b in _present(column)]
    pairs = Pairs(np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept]), len(y), len(chosen))
    del kept
    params = np.zeros(1 + len(chosen) * (1 + FACTORS))
    params[0] = prior
    # Texts kept apart are dealt within each label, so that both are on either side where there are enough.
    apart = np.zeros(len(y), bool)
    for label in (0, 1):
        own = np.random.default_rng(SEED).permutation(np.flatnonzero(y == label))
        apart[own[: len(own) // APART]] = True
    learn, judge = pairs.of(~apart), pairs.of(apart)
    del pairs
    y_learn, y_judge = y[~apart], y[apart]

    # Standard deviations by which a term's toxic texts differ from what its share of texts would give.
    count, toxic, n, n1 = learn.by_slot(np.ones(len(y_learn))), learn.by_slot(y_learn), len(y_learn), y_learn.sum()
    telling = np.abs(toxic - count * n1 / n) / (np.sqrt(count * (n - count) / n * n1 * (n - n1) / n**2) + 1)
    scale, strength = np.ones_like(params), np.ones_like(params)
    scale[1 : 1 + len(chosen)] = np.maximum(telling, LEAST_TELLING) / 3
    strength[0], strength[1 + len(chosen) :] = 0, FACTOR_PENALTY
    judged = lambda x: judge.loss(x * scale, y_judge)[0]

    def path(now: np.ndarray, best: tuple[float, np.ndarray], paired: bool) -> tuple[float, np.ndarray]:
        for penalty in PENALTIES:

            def penalised(x: np.ndarray, by: np.ndarray = penalty * strength) -> tuple[float, np.ndarray]:
                value, grad = learn.loss(x * scale, y_learn, paired)
                return value + float(by @ x**2) / 2, grad * scale + by * x

            now = descend(penalised, now, STEPS)
            found = judged(now) if apart.any() else 0.0
            if found > best[0]:
                break
            best = (found, now)
        return best

    best = path(params, (judged(params), params), False)
    if len(chosen):
        bias, weight, factors = unpack(best[1] * scale)
        error = 1 / (1 + np.exp(-np.clip(learn.logits(bias, weight, factors)[0], -30, 30))) - y_learn
        both = best[1].copy()
        both[1 + len(chosen) :] = interactions(learn, error).ravel()
        best = min(best, path(both, (np.inf, both), True), key=lambda found: found[0])
    bias, weight, factors = unpack(best[1] * scale)
    return ToxicityModel(slot, weight.astype(np.float32), factors.astype(np.float32), bias + float(np.log(shares[1] / shares[0])))


def to_bytes(model: ToxicityModel) -> bytes:
    """The buckets that have a weight, in the order of their places, and all numbers."""
    out = io.BytesIO()
    known = np.flatnonzero(model.slot >= 0)
    np.savez(out, bucket=known[np.argsort(model.slot[known])].astype(np.int32), weight=model.weight, factors=model.factors, bias=model.bias)
    return out.getvalue()


def from_bytes(data: bytes) -> ToxicityModel:
    with np.load(io.BytesIO(data)) as found:
        slot = np.full(BUCKETS, -1, np.int32)
        slot[found["bucket"]] = np.arange(len(found["bucket"]), dtype=np.int32)
        return ToxicityModel(slot, found["weight"], found["factors"], float(found["bias"]))


def _train_rows(shares: tuple[float, float]):
    """Trains on the sample in one task: its texts and what training keeps beside them never reach the driver."""

    def run(rows: pa.Table) -> pa.Table:
        some = sorted(zip(rows.column("_id").to_pylist(), rows.column("_y").to_pylist(), (t or "" for t in rows.column("text").to_pylist()), strict=True))
        return pa.table({"model": pa.array([to_bytes(train([r[2] for r in some], [r[1] for r in some], shares=shares))], pa.binary())})

    return run


def fit(docs: DataFrame, labels: DataFrame, fit_toxic: int = FIT_TOXIC, fit_other: int = FIT_OTHER) -> ToxicityModel:
    """Train on at most ``fit_toxic`` and ``fit_other`` labelled documents that are not held out, those with the smallest id hashes.

    Labels without a document in ``docs`` neither take a place in the sample nor count towards the ratio.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y")).where(~held_out(F.col("_id"), 5, 0) & F.col("_y").isin(0, 1))
    usable = stored(known.join(docs.select("doc_id"), F.col("doc_id") == F.col("_id"), "left_semi"), "toxicity-labels")
    n = {r["_y"]: r["n"] for r in usable.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    bounds = ((1, fit_toxic), (0, fit_other))
    parts = [usable.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(bound) for y, bound in bounds]
    chosen = parts[0].unionAll(parts[1])
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("_id", "_y", "text", F.lit(0).alias("_all"))
    shares = tuple(min(1.0, bound / n[y]) if y in n else 1.0 for y, bound in bounds)
    done = rows.groupBy("_all").applyInArrow(_train_rows(shares), "model binary").first()
    return from_bytes(done["model"]) if done else train([], [], shares=shares)


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(column), pa.float64())

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    A null text is empty; an empty text is scored by the bias. Repeated rows are scored once each.
    Without usable labels every score is 0.5. Other columns are not read.
    """
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), toxicity_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
