"""The training-data operators on small tables, against brute force, libraries and round trips."""

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from maillage.llm import attention, bpe, curve_packing, html_blocks, near_duplicates, ogg, pieces, quality, rule_cascade, toxicity, url_rules

TEXTS = [None, "", " ", "one", "a b c d", "x " * 30, "Ünï don't  stop\n's 12 漢字", "the quick brown fox jumps over the lazy dog again and again " * 3, "w" * 5000]


@pytest.fixture(scope="module")
def docs(spark):
    base = " ".join(f"word{i}" for i in range(60))
    texts = [*TEXTS, base, base, base.replace("word30", "other"), " ".join(f"else{i}" for i in range(40))]
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i > 5), int(i % 2)) for i in range(10)], "doc_id long, quality int, toxic int")


def components(texts: dict) -> dict:
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets, root = {d: shingles(t) for d, t in texts.items()}, {d: d for d in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    return root


def test_near_duplicates_are_those_of_brute_force(spark, docs):
    rng = np.random.default_rng(1)
    base = [f"t{i}" for i in rng.integers(0, 999, 80)]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for k in range(60):  # near copies that are not all alike
        words = list(base)
        for at in rng.integers(0, 80, k % 4):
            words[at] = f"n{k}"
        texts[100 + k] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates.find_near_duplicates(df).collect()}
    assert got == components(texts)


def test_ogg_round_trip_and_damage():
    for text in TEXTS:
        payload, _ = ogg.payload_of(text)
        media = ogg.store(payload)
        back, seen = ogg.restore(media)
        assert back == payload and len(payload) % 192 == 0 and seen["bad_pages"] == seen["lost_packets"] == 0
    broken = bytearray(ogg.store(ogg.payload_of("y" * 300_000)[0]))
    broken[len(broken) // 2] ^= 1
    assert ogg.restore(bytes(broken))[1]["bad_pages"] >= 1
    assert ogg.restore(b"no ogg")[1]["streams"] == 0


def test_ids_equal_the_libraries():
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in TEXTS], add_special_tokens=False)]
    got = [ids[a:b].tolist() for _, ids, rows in bpe.encode_column(path, pa.array(TEXTS)) for a, b in zip(rows[:-1], rows[1:], strict=True)]
    assert got == want
    path = public_tokenizers.path("piece_bpe_32k.model")
    own = pieces.PieceEncoder(path)
    got = [ids[a:b].tolist() for _, ids, rows in own.encode(pa.array(TEXTS)) for a, b in zip(rows[:-1], rows[1:], strict=True)]
    assert got == sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in TEXTS])


def test_packing_is_gapless(docs):
    rows = curve_packing.pack(docs, size=64).collect()
    by_sequence: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0) and len(r.ids) == 4 * r.length
        by_sequence[r.sequence_id] = r.offset + r.length
    assert sorted(by_sequence) == list(range(len(by_sequence))) and all(n == 64 for s, n in by_sequence.items() if s < len(by_sequence) - 1)
    assert {r.doc_id for r in rows} == set(range(docs.count()))


def test_base_scores_are_exact(docs):
    import math
    from collections import Counter

    tokens = {r.doc_id: [*re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), "\n"] for r in docs.collect()}
    count = Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in ws)
    n, v = sum(count.values()), len(count)
    got = attention.score_documents(docs).collect()
    assert len(got) == len(tokens)
    for r in got:
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[r.doc_id]))
        assert (r.n_tokens, r.train_tokens) == (len(tokens[r.doc_id]), n) and r.score < 0


def test_blocks_and_urls_and_rules(spark, docs):
    pages = spark.createDataFrame(
        [(1, "http://a.NET/x", "<nav><a href='/'>Home</a></nav><article><p>Some &amp; text</p><p>More of  it.</p></article><footer>c</footer>"), (2, None, None), (3, "http://www.example.net/en/q?x", "")],
        "page_id long, url string, html string",
    )
    got = {r.page_id: r.blocks for r in html_blocks.extract_blocks(pages).collect()}
    assert got == {1: ["Some & text", "More of it."], 2: [], 3: []}
    judged = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, url_rules.rule_table(spark)).collect()}
    assert judged == {1: ("a.net", "/x", "net/", "block"), 2: ("", "", None, "allow"), 3: ("www.example.net", "/en/q", "example.net/en/", "allow")}
    measured = {r.doc_id: r for r in rule_cascade.judge(docs).collect()}
    assert measured[0].n_words == 0 and measured[0].base_failed and not measured[5].kept and measured[9].kept


def test_classifiers_and_empty_tables(spark, docs, labels):
    empty = docs.where("false")
    for frame, n in ((docs, docs.count()), (empty, 0)):
        assert quality.score_quality(frame, labels).count() == n
        assert toxicity.score_toxicity(frame, labels).count() == n
    assert curve_packing.pack(empty).count() == 0 and near_duplicates.find_near_duplicates(empty).count() == 0
    assert rule_cascade.judge(empty).count() == 0 and pieces.code_documents(empty).count() == 0 and attention.score_documents(empty).count() == 0


def test_toxicity_keeps_the_ratio_of_all_labels(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"word{w}", int(i % 10 == 0)) for i, w in enumerate(rng.integers(0, 3, 3000).tolist())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    # The words tell nothing: a sample of two clean texts for a toxic one is no reason for scores near a third.
    texts = pa.array([r[1] for r in rows])
    bound = toxicity.fit(frame, frame, fit_toxic=150, fit_other=300)
    assert np.mean(bound.score(texts)) < 0.16 and np.isclose(np.mean(toxicity.fit(frame, frame).score(texts)), 0.1, atol=0.03)
    # Of one label only: the prior of all rows, not of the sample. Labels whose document is absent count nowhere.
    one, half = frame.where("toxic = 0"), frame.where("doc_id < 600")
    assert np.isclose(toxicity.fit(one, one, fit_other=10).bias, toxicity.fit(one, one).bias)
    assert np.isclose(toxicity.fit(half, frame, 20, 40).bias, toxicity.fit(half, half, 20, 40).bias)


def test_attention_learns_from_more_than_a_fixed_number_of_texts(spark):
    n = 2 * attention.SHARE * attention.FIT_ROWS
    rows = spark.range(n).selectExpr("id as doc_id", "cast(id as string) as text")
    assert attention.sample(rows).count() > 1.7 * attention.FIT_ROWS and attention.sample(rows.limit(1000)).count() == 1000
    # Neighbours are those of brute force, within texts that are not held out.
    ids, bounds, context = np.array([5, 6, 5, 7, 6, 5]), np.array([0, 3, 3, 5, 6]), np.array([-1] * 5 + [0, 1, -1])
    codes = sorted(np.concatenate(list(attention.near_codes(ids, bounds, np.array([True, True, True, False]), context, 2))).tolist())
    assert codes == sorted([25, 30, 25, 35, 30, 25 + 1 + 1, 30 + 1 + 0, 35 + 1 + 1, 30 + 3 + 0, 25 + 3 + 1])
    # An id beyond the most frequent ones joins the class of those with its neighbours.
    size, width = attention.FREQUENT + 500, 50
    of = np.arange(size)
    codes = np.concatenate([of * (2 * width + 1), of * (2 * width + 1) + 1 + of % width])
    times = np.concatenate([np.arange(size, 0, -1), np.full(size, 3)])
    group, count = attention.classes_of(codes, times, width, np.append(np.ones(size, bool), False))
    assert (group[attention.FREQUENT : size] > 1).all() and (group[:size] == group[of % width]).all() and count[0] == size


def test_toxicity_is_trained_outside_of_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, f"same {'bad' if i % 3 == 0 else 'good'} word{w}", int(i % 3 == 0)) for i, w in enumerate(rng.integers(0, 9, 300).tolist())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    train, driver = toxicity.train, os.getpid()
    want = train([r[1] for r in learned], [r[2] for r in learned])

    def elsewhere(*args, **kwargs):
        assert os.getpid() != driver
        return train(*args, **kwargs)

    monkeypatch.setattr(toxicity, "train", elsewhere)
    got = toxicity.fit(frame, frame)
    assert (got.slot == want.slot).all() and (got.weight == want.weight).all() and (got.factors == want.factors).all() and got.bias == want.bias


def test_attention_is_trained_on_every_text_that_is_not_held_out(spark, monkeypatch):
    # A share of one in 64 of all texts is far from all their ids; chunks hold every one.
    monkeypatch.setattr(attention, "FIT_ROWS", 1)
    rows = [(i, f"word{i} other{i % 7}") for i in range(640)]
    learned = [t for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    own, fit, models = attention.subwords(public_tokenizers.path(attention.VOCABULARY)), attention.fit, []
    monkeypatch.setattr(attention, "fit", lambda *args: models.append(fit(*args)) or models[-1])
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert attention.score_documents(frame).count() == len(rows)
    ids = np.unique(own.split([w for t in learned for w in t.split()])[0])
    assert (models[0].row[ids] >= attention.CLASSES).all()  # each was met in training and has a row of its own
    # Weights are averaged as rows and come back as they were.
    params = attention.start(np.arange(500) % attention.CLASSES, np.ones(500, np.int64)).params
    back = attention.from_rows(attention.to_rows(params), params)
    assert all((back[k] == v).all() for k, v in params.items()) and back.keys() == params.keys()


@pytest.mark.parametrize("fillers", [300, 6000])
def test_toxicity_learns_what_two_terms_say_together(fillers):
    """Toxic is just one of two words that tell nothing alone, among many others that tell nothing at all."""
    rng = np.random.default_rng(5)

    def some(n):
        texts, labels = [], []
        for one, two in rng.integers(0, 2, (n, 2)).tolist():
            words = [f"filler{k}" for k in rng.integers(0, fillers, 40)] + ["insult"] * one + ["group"] * two
            rng.shuffle(words)
            texts.append(" ".join(words))
            labels.append(int(one != two))
        return texts, labels

    model = toxicity.train(*some(4000))
    texts, labels = some(1000)
    assert np.mean((model.score(pa.array(texts)) >= 0.5) == np.array(labels)) > 0.95
    assert (model.slot >= 0).sum() >= fillers * 0.9  # no term was left out


def test_toxicity_gradient_is_that_of_differences():
    rng = np.random.default_rng(2)
    row, slot = np.divmod(np.unique(rng.integers(0, 12 * 7, 40)), 7)
    pairs, y = toxicity.Pairs(row, slot, 12, 7), rng.integers(0, 2, 12).astype(float)
    x = rng.normal(size=1 + 7 * (1 + toxicity.FACTORS))
    grad = pairs.loss(x, y, True)[1]
    for at in range(len(x)):
        step = np.zeros_like(x)
        step[at] = 1e-5
        assert grad[at] == pytest.approx((pairs.loss(x + step, y, True)[0] - pairs.loss(x - step, y, True)[0]) / 2e-5, abs=1e-5)


def test_near_duplicates_keep_texts_of_one_id_apart(spark):
    base, unlike = " ".join(f"word{i}" for i in range(60)), " ".join(f"else{i}" for i in range(40))
    rows = [(5, base), (7, base), (7, unlike), (7, unlike), (9, base.replace("word30", "x")), (9, base.upper()), (None, base), (11, None)]
    for kind, name in (("long", lambda i: i), ("string", lambda i: None if i is None else f"{i:02}")):
        docs = spark.createDataFrame([(name(i), t, "clash") for i, t in rows], f"doc_id {kind}, text string, kept string")
        got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_duplicates.find_near_duplicates(docs).collect())
        want = [(5, 5, True), (7, 5, False), (7, 7, True), (7, 7, True), (9, 5, False), (9, 5, False), (None, None, True), (11, 11, True)]
        assert got == sorted((str(name(i)), str(name(c)), k) for i, c, k in want)
    import corpus_pipeline

    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, digest string")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted(map(str, left.select("doc_id", "text").collect())) == sorted(
        map(str, spark.createDataFrame([(5, base), (7, unlike), (None, base), (11, None)], "doc_id long, text string").collect())
    )


def test_near_duplicates_among_many_texts_with_a_shared_half(spark):
    """Unlike texts that share half their words meet in all buckets; a few of them have near copies."""
    rng = np.random.default_rng(4)
    half = [f"t{i}" for i in range(60)]
    texts = {}
    for k in range(300):
        own = [f"u{k}x{i}" for i in range(60)]
        texts[k] = " ".join(half + own)
        if k % 25 == 0:
            for c in range(1, 4):
                near = list(own)
                near[int(rng.integers(0, 60))] = f"n{k}x{c}"
                texts[1000 * c + k] = " ".join(half + near)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    # Copies share 106 of 126 shingles at least, other texts 56 of 176.
    assert {r.doc_id: r.component_id for r in near_duplicates.find_near_duplicates(df).collect()} == {d: d % 1000 for d in texts}


def test_attention_gradient_sums_and_windows():
    rng = np.random.default_rng(9)
    size, end = 30, 29
    group = np.append(rng.integers(1, attention.CLASSES, end), 0)
    model = attention.start(group, np.ones(size, np.int64))
    bounds = np.array([0, 1, 40, 100])
    ids = rng.integers(0, end, 100)
    ids[bounds[1:] - 1] = end
    queries, keys, known, place = attention.blocks(model.row[ids], bounds, int(model.row[end]))
    assert sorted(place[place >= 0].tolist()) == list(range(100))  # every id is scored once
    # Masked attention, place by place.
    own, lead = model.class_scores(ids, bounds, end)
    p = {k: v.astype(float) for k, v in model.params.items()}
    at_block = {int(q): (b, j) for b, row in enumerate(place) for j, q in enumerate(row) if q >= 0}
    for at in range(100):
        first = max(b for b in bounds if b <= at)
        begin = max(first, first + ((at - first) // attention.BLOCK - 1) * attention.BLOCK)
        rows = [model.row[end] if k == first else model.row[ids[k - 1]] for k in range(begin, at + 1)]
        e = p["embed"][rows]
        weight = np.exp(e @ p["k"] @ (e[-1] @ p["q"]) + p["near"][np.arange(len(rows))[::-1]])
        seen = np.concatenate((weight / weight.sum() @ (e @ p["v"]), e[-1]))
        logits = np.maximum(seen @ p["w1"] + p["b1"], 0) @ p["w2"] + p["b2"]
        share = np.exp(logits) / np.exp(logits).sum()
        assert own[at] == pytest.approx(np.log10(share[group[ids[at]]]), abs=1e-4)
        assert lead[at] == pytest.approx(np.log10(share[: attention.LEADING].sum()), abs=1e-4)
        b, j = at_block[at]
        assert np.allclose(model.forward(queries, keys, known)[b, j], logits, atol=1e-3)
    # Numeric gradients, in double precision.
    model.params, model._tables, model._steep = p, None, True
    target = np.where(place >= 0, group[ids][place], -1)

    def loss():
        model._tables = None
        logits = model.forward(queries, keys, known)
        whole = np.log(np.exp(logits).sum(2))
        there = target >= 0
        return (whole[there] - logits[(*np.nonzero(there), target[there])]).mean()

    model._tables = None
    grads = attention.gradients(model, queries, keys, known, target)
    for name, grad in grads.items():
        values = p[name].reshape(-1)
        for at in rng.choice(len(values), min(12, len(values)), replace=False):
            was, step, both = values[at], 1e-5, []
            for sign in (1, -1):
                values[at] = was + sign * step
                both.append(loss())
            values[at] = was
            assert grad.reshape(-1)[at] == pytest.approx((both[0] - both[1]) / (2 * step), abs=2e-4), name


def test_attention_sums_of_equal_rows():
    rng = np.random.default_rng(12)
    for size in (1, 40, (1 << 16) + 5):
        rows, values = rng.integers(max(0, size - 40), size, 300), rng.integers(-9, 9, (300, 3)).astype(np.float32)
        want = np.zeros((size, 3), np.float32)
        np.add.at(want, rows, values)
        assert (attention.sums_by_input(values, rows, size) == want).all()


def test_attention_is_trained_on_words_and_finds_their_ids_by_counts(monkeypatch):
    rng = np.random.default_rng(14)
    end, n_words = 60, 40
    group = np.append(np.where(np.arange(end) < 30, rng.integers(2, attention.LEADING, end), rng.integers(attention.LEADING, attention.CLASSES, end)), 0)
    size = np.append(rng.integers(1, 5, n_words - 1), attention.LONG + 9)
    offsets = np.append(0, np.cumsum(size))
    ids = rng.integers(30, end, offsets[-1])
    ids[offsets[:-1]] = rng.integers(0, 30, n_words)
    # A word is the mean of its ids' rows, however many it has.
    model = attention.start(group, np.ones(end + 1, np.int64), attention.LEADING)
    want = np.stack([model.params["embed"][model.row[ids[a:b]]].mean(0) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
    assert np.allclose(attention.means(model.params["embed"], model.row[ids], offsets), want, atol=1e-6)
    # Each word and each text's end is one prediction; every id of theirs is moved.
    words, rows, seen = rng.integers(0, n_words, 300), np.array([0, 0, 100, 300]), []
    gradients, before = attention.gradients, model.params["embed"].copy()
    monkeypatch.setattr(attention, "gradients", lambda *args: seen.append((args[4] >= 0).sum()) or gradients(*args))
    times = attention.train(model, words, rows, ids, offsets, end, (0.01, 0.01), {})
    assert sum(seen) == 300 + 3 and times[model.row[end]] == 3 and times.sum() == size[words].sum() + 3
    assert ((model.params["embed"] != before).any(1) == (times > 0)).all()
    first, ends = model.word_scores(words, rows, ids, offsets, end)
    assert len(first) == 300 and len(ends) == 3 and (first < 0).all() and (ends < 0).all()
    # After every id, the end of the word and all ids that go on with it add up to one.
    fine = attention.alone(group, np.bincount(ids, minlength=end + 1), np.append(np.arange(end) < 30, False))
    pairs = np.bincount(attention.pair_codes(ids, offsets, group), minlength=(attention.CLASSES + 1) * (end + 1)).reshape(-1, end + 1)
    codes, n = np.unique(attention.follow_codes(ids, offsets, fine), return_counts=True)
    followers, emission = attention.Followers.of(codes, n, group, fine), attention.emission_table(fine, pairs)
    for one in range(end):
        after = np.arange(30, end)
        share = 10.0 ** (followers.score(one * attention.FOLLOWS + fine[after] - (attention.LEADING - 1)) + emission[group[one], after])
        assert share.sum() + 10.0 ** followers.score(np.array([one * attention.FOLLOWS]))[0] == pytest.approx(1, abs=1e-5)


def test_attention_counts_words_over_all_chunks_by_bucket():
    rng = np.random.default_rng(15)
    words = rng.integers(-(1 << 62), 1 << 62, 5000)
    chunks = {c: rng.permutation(words)[:n] for c, n in ((7, 3000), (9, 0), (1 << 33, 4000))}
    trained = {c: rng.integers(0, 3, len(k)) for c, k in chunks.items()}
    part = pa.RecordBatch.from_arrays([pa.array(list(chunks)), pa.array([k.tolist() for k in chunks.values()], pa.list_(pa.int64())), pa.array([n.tolist() for n in trained.values()], pa.list_(pa.int64()))], ["chunk", "keys", "trained"])
    rows = pa.Table.from_batches(list(attention._by_bucket(iter([part]))))
    assert rows.num_rows > attention.BUCKETS and rows.schema.names == [c.split()[0] for c in attention.BUCKET.split(", ")]
    want, got, totals = {}, {c: np.zeros(len(k), np.int64) for c, k in chunks.items()}, np.zeros(2, np.int64)
    for c, keys in chunks.items():
        for key, n in zip(keys.tolist(), trained[c].tolist(), strict=True):
            want[key] = want.get(key, 0) + n
    buckets = rows.column("bucket").to_numpy()
    for bucket in np.unique(buckets):
        for row in attention._counts(rows.filter(pa.array(buckets == bucket))).to_pylist():
            got[row["of_chunk"]][np.frombuffer(row["pos"], np.uint32)] = np.frombuffer(row["c"], np.int64)
            totals += row["total"], row["n_words"]
    assert all(got[c].tolist() == [want[k] for k in keys.tolist()] for c, keys in chunks.items())
    assert totals.tolist() == [sum(want.values()), sum(n > 0 for n in want.values())]


def test_ids_of_a_class_sum_to_one():
    rng = np.random.default_rng(10)
    group = rng.integers(0, attention.CLASSES, 500)
    table = attention.emission_table(group, rng.integers(0, 9, (attention.CLASSES + 1, 500)).astype(float))
    for row in table:
        sums = np.bincount(group, 10.0 ** row.astype(float), attention.CLASSES)
        assert np.allclose(sums[np.unique(group)], 1, atol=1e-4)
