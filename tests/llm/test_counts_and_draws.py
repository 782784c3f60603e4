"""Importance resampling, source divergence and token counts against plain Python on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from maillage.llm import divergence, importance, token_counts
from maillage.llm.queries import op13_token_counts
from maillage.llm.text import batches

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "-!?", "one", "ÀB à b\x00c 3D É", "Ünï don't  stop\n's 12 漢字 “quoted” — 😀", "x" * 20_000, "a b " * 20_000, "𠀀 <|endoftext|> tail", "\n\n \t"]


def some_texts(n=60, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "AbC", "don't", "x-y"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*ODD, *texts, texts[0], texts[0]]


# ---- importance resampling


def features(text):
    w = re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def drawn_by_hand(rows, target, percent=25, min_words=20, buckets=10_000, seed=7):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = (Counter(bucket(f) for x in texts for f in features(x)) for texts in ([x for _, x in rows], target))
    all_s, all_t = (sum(c.values()) + buckets for c in (s, t))
    out = []
    for doc_id, text in rows:
        f = features(text)
        gains = [math.floor(1000 * math.log((t[bucket(x)] + 1) * all_s / ((s[bucket(x)] + 1) * all_t))) for x in f]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    eligible = sorted((r for r in out if r[1] >= 2 * min_words - 1), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    rank = Counter()
    places = {}
    for k, r in enumerate(eligible[: percent * len(eligible) // 100]):
        places.setdefault(r, []).append(k + 1)
    result = []
    for r in out:
        result.append((*r, places[r][rank[r]] if rank[r] < len(places.get(r, [])) else None))
        rank[r] += 1
    return Counter(result)


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    return some_texts()


def test_draw_is_that_of_brute_force(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[-3]), (5, texts[-4]), (5, texts[-4])]
    target = [*texts[15:20], None, ""]
    docs = spark.createDataFrame([(i, t, "clash", 1.5) for i, t in rows], "doc_id long, text string, rank string, weight double").repartition(3)
    aim = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, n int")
    for percent in (25, 100, 0):
        got = rows_of(importance.resample(docs, aim, percent), "doc_id", "n_features", "weight", "score", "rank")
        assert got == drawn_by_hand(rows, target, percent)


def test_draw_settles_ties_by_id(spark):
    text = " ".join(f"v{i}" for i in range(30))
    rows = [(7, text)] * 6 + [(9, text)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(importance.resample(docs, docs, 50), "doc_id", "rank")
    assert sum(got.values()) == 9 and sorted(r for _, r in got.elements() if r) == [1, 2, 3, 4]
    assert rows_of(importance.resample(docs, docs, 50), "doc_id", "n_features", "weight", "score", "rank") == drawn_by_hand(rows, [t for _, t in rows], 50)


def test_draw_from_nothing_and_towards_nothing(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id string, text string")
    none = docs.where("false")
    assert importance.resample(none, docs).collect() == []
    got = rows_of(importance.resample(docs, none), "doc_id", "n_features", "weight", "score", "rank")
    assert got == drawn_by_hand([(str(i), t) for i, t in enumerate(texts)], [])


def test_joined_checksums():
    rng = np.random.default_rng(2)
    parts = [(rng.bytes(int(rng.integers(0, 9))), rng.bytes(int(n))) for n in rng.integers(0, 70, 500)]
    first, second = (np.array([zlib.crc32(p[k]) for p in parts], np.uint32) for k in range(2))
    got = importance.joined_crc32(first, second, np.array([len(p[1]) for p in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]


# ---- divergence


def divergence_by_hand(rows, least=3, top=200):
    docs = [(lang or "", source or "", re.findall("[a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))) for lang, source, text in rows]
    seen, out = Counter(), Counter()
    for lang, _, w in docs:
        seen.update((lang, t) for t in set(w))
    for lang in {d[0] for d in docs}:
        kept = sorted(t for (g, t), n in seen.items() if g == lang and n >= least)
        v = len(kept)
        counts = {s: Counter(t for g, x, w in docs if (g, x) == (lang, s) for t in w if t in set(kept)) for s in {d[1] for d in docs if d[0] == lang}}
        whole = sum(counts.values(), Counter())

        def share(c, t, v=v):
            return 1 + math.floor(Fraction(10**9 * (c[t] + 1), sum(c.values()) + v))

        for s, c in counts.items():
            pairs = [(o, sum((share(c, t) - share(d, t)) ** 2 // share(d, t) for t in kept)) for o, d in counts.items() if o != s]
            terms = [(t, (share(c, t) - share(whole, t)) ** 2 // share(whole, t)) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out.update((lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ordered))
    return out


COLUMNS = ("lang", "source", "part", "item", "value", "rank")


@pytest.mark.parametrize("shard_rows", [divergence.SHARD_ROWS, 20])
def test_divergence_is_that_of_brute_force(spark, texts, shard_rows, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(divergence, "SCATTER", 7)
    rng = random.Random(5)
    rows = [(rng.choice(["en", "fr", None, ""]), rng.choice(["a", "b", "c", None, "é"]), t) for t in texts * 2]
    rows += [("en", "silent", ""), ("xx", "alone", "word word"), ("yy", "p", "rare"), ("yy", "q", "other"), ("en", "silent2", None)]
    docs = spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string, term string").repartition(3)
    assert rows_of(divergence.source_divergence(docs), *COLUMNS) == divergence_by_hand(rows)


def test_divergence_of_nothing_and_ties(spark):
    docs = spark.createDataFrame([("l", s, "bb aa cc") for s in "pqr"] + [("l", "p", "aa bb")], "lang string, source string, text string")
    assert rows_of(divergence.source_divergence(docs, top_terms=1), *COLUMNS) == divergence_by_hand([tuple(r) for r in docs.collect()], top=1)
    assert divergence.source_divergence(docs.where("false")).collect() == []


def test_shares_are_exact(spark):
    big = [(0, 1), (5, 6), (10**15, 8 * 10**15 + 1), (3, 7 * 10**15), (999, 10**6), (4 * 10**12, 9 * 10**12 + 7)]
    df = spark.createDataFrame(big, "c long, m long")
    got = [r.p for r in df.select(divergence.share(df.c, df.m).alias("p")).collect()]
    assert got == [1 + 10**9 * (c + 1) // m for c, m in big]


# ---- token counts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def lengths(tokenizer, texts):
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_counts_are_the_librarys(spark, texts, tokenizer):
    rows = [(i, t, -1) for i, t in enumerate(texts)] + [(None, "null id", 0), (3, "a", 0), (3, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long").repartition(3)
    want = Counter((i, len((t or "").encode()), n, n > 100) for (i, t, _), n in zip(rows, lengths(tokenizer, [r[1] for r in rows]), strict=True))
    assert rows_of(token_counts.count_tokens(docs, 100), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.count_tokens(docs.where("false")).collect() == []
    assert rows_of(token_counts.count_tokens(docs.where("text is null or text = ''")), "doc_id", "n_tokens") == Counter({(0, 0): 1, (1, 0): 1})


def test_counts_of_random_characters(tokenizer):
    rng = random.Random(9)
    alphabet = ["a", "b", " ", "  ", "\n", "'s", "'re", "'", "1", "²", "é", "漢", "“", "—", "😀", "\xa0", "　", "𠀀", "x'll", "̀", "‍", "٣", "Ⅷ", "<|endoftext|>"]
    mixed = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    mixed += ["".join(chr(rng.choice((rng.randint(32, 0xD7FF), rng.randint(0xE000, 0x1FFFF), rng.randint(32, 127)))) for _ in range(30)) for _ in range(1000)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter = token_counts.Counter(path, token_counts.folding(path))
    got = np.concatenate([counter.count(t) for t in batches(pa.array(mixed), 1 << 14)])
    assert got.tolist() == lengths(tokenizer, mixed)


def test_both_tiers_hold_what_they_were_given():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(1, 2**63, 5000, np.int64).view(np.uint64) & ~np.uint64(0xFF0))  # many share a slot
    table = token_counts.FrequentLengths.build(keys, (keys % np.uint64(60000)).astype(np.int64))
    assert (table.look_up(keys) == (keys % np.uint64(60000)).astype(np.int64)).all()
    assert (table.look_up(keys + np.uint64(16)) == -1).all()


def test_the_query_counts_every_document(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = dict(zip(docs, lengths(tokenizer, docs.values()), strict=True))
    assert {r.doc_id: r.n_tokens for r in op13_token_counts(spark, folder).collect()} == want
