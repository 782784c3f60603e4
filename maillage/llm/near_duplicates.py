"""MinHash near-duplicates: universal hash minima in bands, signature check, full check, components.

1. Every whole text becomes a set of 64-bit hashes of five-word shingles, a 128-bit digest of that set,
   and the minima of many universal hash functions, kept as band keys and as one byte each.
2. Texts with one digest are one node, and the digest is its name. Ids name no node, so texts that share
   an id are kept apart.
3. Nodes that share a band key are candidates. Each is first compared with the smallest node of its bucket
   only, so a bucket makes one pair per member: signatures first, then the full sets. Confirmed links are
   joined into components.
4. Buckets whose members still lie in several components are compared block by block inside tasks of
   bounded size. A block emits links of a spanning forest, never its pairs.
5. Links become components by alternating large-star and small-star rounds.

Band keys meet with a probability of 1 - (1 - s**ROWS)**BANDS for similarity s: 0.999995 at 0.75.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.llm.columns import stored
from maillage.llm.text import LOWER, Texts, batches, mix, prefix_sums, windows
from maillage.operators.joins import join_unique

SHINGLE = 5
THRESHOLD = 75  # percent: 100 * intersection >= THRESHOLD * union
BANDS, ROWS = 32, 4
# Of the 128 minima, so many agree at least: 5.4 standard deviations below the mean at similarity 0.75.
MIN_AGREE = 70
BLOCK = 1024  # members of a bucket compared in one task, against as many
FILTER_BITS = 1 << 23  # of the filter that keeps other texts out of the shuffle: 1 MB
BITMAP_BITS = 32768  # of one bitmap of Spark's bitmap functions, a fixed value
SEED = 3

_U = np.uint64
_rng = np.random.default_rng(SEED)
_A = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_MULTIPLIERS = _rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) | _U(1)
_BAND_MULTIPLIERS = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | _U(1)


def shingle_sets(texts: Texts) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a text with fewer words has one for all of them, one without words none."""
    data = LOWER[texts.data]
    starts, ends = texts.words()
    words = windows(prefix_sums(data), starts, ends)
    rows = texts.rows_of(starts)
    n = len(words) - SHINGLE + 1
    full = np.zeros(max(n, 0), _U)
    for k in range(SHINGLE if n > 0 else 0):
        full += words[k : k + n] * _MULTIPLIERS[k]
    full = mix(full)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if b - a >= SHINGLE:
            yield np.unique(full[a : b - SHINGLE + 1])
        elif b > a:
            yield mix(np.array([(words[a:b] * _MULTIPLIERS[: b - a]).sum() + _U(b - a)], _U))
        else:
            yield np.zeros(0, _U)


def minima(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each universal hash function (a * x + b modulo 2**32) over a set."""
    x = (shingles >> _U(32)).astype(np.uint32)
    out = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        np.minimum(out, (_A[:, None] * x[None, at : at + 512] + _B[:, None]).min(1), out=out)
    return out


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for texts in batches(part.column("text")):
            size, digest, signature, keys = [], [], [], []
            for shingles in shingle_sets(texts):
                size.append(len(shingles))
                if not len(shingles):
                    digest.append(None), signature.append(None), keys.append(None)
                    continue
                low = minima(shingles)
                digest.append(_digest(shingles))
                signature.append(low.astype(np.uint8).tobytes())
                band = mix((low.reshape(BANDS, ROWS).astype(_U) * _BAND_MULTIPLIERS).sum(1) + np.arange(BANDS, dtype=_U))
                keys.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).slice(texts.lo, texts.n) for c in ("doc_id", "text_md5")), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(signature, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "text_md5", "n_shingles", "digest", "signature", "bands"],
            )


def text_md5(text: Column) -> Column:
    """Tells the texts of rows that share a doc_id apart; a null text is empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("text_md5")


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, md5 of the text, n_shingles, digest of the set, one byte of each minimum, band keys; the last three null for an empty set."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", text_md5(F.col("text"))).mapInArrow(_sketch, f"doc_id {kind}, text_md5 string, n_shingles long, digest binary, signature binary, bands array<long>")


def _sets(bits: np.ndarray):
    """Digests and full sets of the texts whose id hash (column h) has its bit set."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            h = part.column("h").to_numpy()
            part = part.filter(pa.array((bits[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1))
            for texts in batches(part.column("text")):
                sets = [s for s in shingle_sets(texts) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array(map(_digest, sets), pa.binary()), pa.array((s.tobytes() for s in sets), pa.binary())], ["node", "shingles"])

    return run


def _agree(a: pa.Array, b: pa.Array) -> pa.Array:
    """Minima on which two signatures agree."""
    left, right = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for x in (a, b))
    return pa.array((left == right).sum(1).astype(np.int32))


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Whether two sorted sets of hashes are similar enough."""
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < threshold * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def _confirm(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([linked(np.frombuffer(x, _U), np.frombuffer(y, _U)) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())


def forest(component: np.ndarray, left: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray], same: bool) -> list[tuple[int, int]]:
    """Links (places of two members) between members in different components, as a spanning forest. ``left``: members of the first block; ``same``: both are one block."""
    component, edges = component.copy(), []
    for i in np.flatnonzero(left):
        others = np.flatnonzero((component != component[i]) & (np.arange(len(sets)) > i if same else ~left))
        if not len(others):
            continue
        others = others[(signatures[others] == signatures[i]).sum(1) >= MIN_AGREE]
        for j in others:
            if component[j] != component[i] and linked(sets[i], sets[j]):
                edges.append((int(i), int(j)))
                component[component == component[j]] = component[i]
    return edges


def _compare_block(block: pa.Table) -> pa.Table:
    a, b = block.column("a")[0].as_py(), block.column("b")[0].as_py()
    block = block.take(pc.sort_indices(block.column("node"))).combine_chunks()
    signatures = np.frombuffer(b"".join(block.column("signature").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
    sets = [np.frombuffer(x, _U) for x in block.column("shingles").to_pylist()]
    component = np.unique(block.column("component").to_pylist(), return_inverse=True)[1]
    edges = forest(component, block.column("block").to_numpy() == a, signatures, sets, a == b)
    return pa.table({c: block.column("node").take(pa.array([e[at] for e in edges], pa.int64())) for at, c in enumerate("xy")})


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node in ``links`` (x, y) but those that are the smallest of theirs.

    Large-star ties every larger neighbour of a node to the node's smallest neighbour, small-star every
    smaller one; alternated until nothing changes, every node hangs on the smallest of its component.
    The smallest neighbour is a combined aggregate and is joined back, so a node of very many links is
    never gathered. The join does not run where the aggregate did (``join_unique``), so adaptive
    execution can split such a node. Self-links and repeats do no harm.
    """
    links = links.where(F.col("x") != F.col("y")).select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    links = stored(links, "links")
    state = _fingerprint(links)
    while True:
        both = links.unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = join_unique(both.where(F.col("y") > F.col("x")), low, ["x"], "inner").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        large = stored(large, "large-star")
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = join_unique(large, low, ["x"], "inner").where(F.col("y") != F.col("m")).select(F.col("y").alias("x"), F.col("m").alias("y"))
        links = stored(small.unionAll(low.select("x", F.col("m").alias("y"))).distinct(), "small-star")
        before, state = state, _fingerprint(links)
        if state == before:
            return links.groupBy("x").agg(F.min("y").alias("component")).select(F.col("x").alias("node"), "component")


def find_near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, text_md5.

    Texts without words are linked with nothing, as are rows with a null doc_id (component_id null, kept).
    A null text is empty. Equal texts are linked, however many there are. Different texts that share a
    doc_id are told apart: each has the component of its own text, and of a component only the rows with
    the smallest doc_id, and of those with the smallest md5 of the text, are kept. Repeated rows have
    equal results. Ids may be of any type with an order. An empty table gives an empty result. Other
    columns are not read.
    """
    sketch = stored(sketches(docs), "sketches")
    some = sketch.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = stored(some.groupBy("digest").agg(F.min(F.struct("doc_id", "text_md5")).alias("least")).select(F.col("digest").alias("node"), "least"), "classes")
    reps = some.join(classes, (some["doc_id"] == F.col("least.doc_id")) & (some["text_md5"] == F.col("least.text_md5")) & (some["digest"] == F.col("node")))
    reps = stored(reps.select("node", "signature", "bands").dropDuplicates(["node"]), "nodes")
    members = reps.select("node", F.explode("bands").alias("key")).distinct()
    buckets = members.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where(F.col("n") > 1)
    members = stored(join_unique(members, buckets, ["key"], "inner").where(F.col("node") != F.col("pivot")), "candidates")

    # One pair per member: signatures, then full sets.
    signatures = reps.select("node", "signature")
    pairs = members.select("pivot", "node").distinct()
    agree = F.arrow_udf(_agree, "int")
    pairs = pairs.join(signatures, "node").withColumnRenamed("signature", "sig_y")
    pairs = join_unique(pairs, signatures.select(F.col("node").alias("pivot"), F.col("signature").alias("sig_x")), ["pivot"], "inner")
    pairs = pairs.where(agree("sig_x", "sig_y") >= MIN_AGREE).select("pivot", "node")
    pairs = stored(pairs, "pairs")
    confirmed = stored(_verify(docs, classes, pairs), "confirmed")
    component = connected_components(confirmed)

    # Buckets whose members, the pivot aside, are in several components.
    placed = members.where(F.col("n") > 2).select("key", "node").join(component, "node", "left")
    placed = placed.select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
    mixed = mixed.where(F.col("lo") != F.col("hi")).select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    left = stored(join_unique(placed, mixed, ["key"], "inner"), "mixed")
    if not left.isEmpty():
        more = _compare_buckets(docs, classes, left, signatures)
        hung = component.select(F.col("node").alias("x"), F.col("component").alias("y"))
        component = connected_components(hung.unionAll(stored(more, "more-links")))

    # The smallest document of every component, and of every class without links. The node that a component is named after has no row.
    component = component.unionAll(component.select(F.col("component").alias("node"), "component").distinct())
    least = component.join(classes, "node").groupBy("component").agg(F.min("least").alias("lowest"))
    lowest = join_unique(component, least, ["component"], "inner").select("node", "lowest")
    classes = classes.join(lowest, "node", "left").select(F.col("node").alias("digest"), F.coalesce("lowest", "least").alias("lowest"))
    out = sketch.select("doc_id", "text_md5", "n_shingles", "digest").join(classes, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("lowest.doc_id", "doc_id"))
    kept = F.coalesce((F.col("doc_id") == F.col("lowest.doc_id")) & (F.col("text_md5") == F.col("lowest.text_md5")), F.lit(True))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), kept.alias("kept"), "text_md5")


def _bit(column: Column) -> Column:
    return F.xxhash64(column).bitwiseAND(FILTER_BITS - 1)


def _bits_of(ids: DataFrame) -> np.ndarray:
    """One bit for every id hash in ``ids`` (column id): FILTER_BITS bits, whatever the number of ids."""
    # The bitmap functions count from 1.
    parts = ids.select((_bit(F.col("id")) + 1).alias("h")).groupBy(F.bitmap_bucket_number("h").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in parts.collect():
        lo = (row["part"] - 1) * (BITMAP_BITS // 8)
        piece = np.frombuffer(bytes(row["bits"]), np.uint8)
        bits[lo : lo + len(piece)] = piece[: len(bits) - lo]
    return bits


def _sets_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Full sets of ``nodes``. The bits of their smallest ids spare other texts the work and the shuffle; the join then is exact."""
    nodes = nodes.select("node").distinct()
    ids = classes.join(nodes, "node", "left_semi").select(F.col("least.doc_id").alias("id"))
    few = docs.where(F.col("doc_id").isNotNull()).select("text", _bit(F.col("doc_id")).alias("h"))
    sets = few.mapInArrow(_sets(_bits_of(ids)), "node binary, shingles binary")
    return sets.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (x, y) whose full sets are similar enough."""
    sets = stored(_sets_of(docs, classes, pairs.select("node").unionAll(pairs.select("pivot"))), "sets")
    joined = pairs.join(sets, "node").withColumnRenamed("shingles", "set_y").join(sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("set_x")), "pivot")
    return joined.where(F.arrow_udf(_confirm, "boolean")("set_x", "set_y")).select(F.col("pivot").alias("x"), F.col("node").alias("y"))


def _compare_buckets(docs: DataFrame, classes: DataFrame, members: DataFrame, signatures: DataFrame) -> DataFrame:
    """Links between members (key, node, component, blocks) of one bucket in different components."""
    own = (F.xxhash64("node").bitwiseAND(0x7FFFFFFF) % F.col("blocks")).cast("int")
    spread = members.withColumn("block", own).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.select("key", "node", "component", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    full = spread.join(signatures, "node").join(_sets_of(docs, classes, members), "node")
    full = full.select("key", "node", "component", "block", "a", "b", "signature", "shingles")
    return full.groupBy("key", "a", "b").applyInArrow(_compare_block, "x binary, y binary").distinct()
