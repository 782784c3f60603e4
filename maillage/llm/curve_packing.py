"""Packing: documents in the order of a space-filling curve, cut into sequences of one length.

A document's ids are hashed into a signed vector, projected to three dimensions and squashed; the
Hilbert index of that point is its key. Documents are sorted by key in ranges, laid end to end along
the curve, and cut every ``SEQUENCE`` ids. Neighbours on the curve share a sequence, and only the last
sequence is not full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage.llm.bpe import encode_column
from maillage.llm.columns import stored
from maillage.llm.text import sums_by_row

SEQUENCE = 2048
END_ID = 1  # closes every document
TOKENIZER = "byte_bpe_50k.json"
HASHED = 64  # size of the hashed document vector
DIMENSIONS, BITS = 3, 16
SPREAD = 24.0  # scale of the mean vector before squashing
SEED = 5


def hilbert_key(point: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points (n, dims), by transposing axes bit by bit."""
    x = [c.astype(np.int64).copy() for c in point.T]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[-1] & q, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ t) >> b) & 1)
    return key


def projection(vocabulary: int) -> np.ndarray:
    """Contribution of every id: its hashed, signed place in the document vector, projected."""
    rng = np.random.default_rng(SEED)
    axes = rng.normal(size=(HASHED, DIMENSIONS))
    h = np.arange(vocabulary, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return axes[(h >> np.uint64(58)).astype(int)] * np.where((h >> np.uint64(40)) & np.uint64(1), 1, -1)[:, None]


def curve_keys(ids: np.ndarray, rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents whose ids lie between consecutive offsets ``rows``."""
    count = np.maximum(np.diff(rows), 1)
    mean = np.stack([sums_by_row(c[ids], rows) / count for c in table.T], 1)
    point = np.floor((np.tanh(SPREAD / 8 * mean) + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64)
    return hilbert_key(point)


def _encode(path: str, end_id: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for part in parts:
            for lo, ids, rows in encode_column(path, part.column("text")):
                n = len(rows) - 1
                ids = np.insert(ids, rows[1:], end_id).astype("<u4")
                rows = rows + np.arange(n + 1)
                if table is None or len(table) <= ids.max():
                    table = projection(max(1 << 16, int(ids.max()) + 1))
                raw = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((rows * 4).astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row").slice(lo, n), part.column("doc_id").slice(lo, n), raw.cast(pa.binary()), pa.array(np.diff(rows)), pa.array(curve_keys(ids, rows, table))],
                    ["_row", "doc_id", "ids", "n", "key"],
                )

    return run


def _running(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part_id, before = TaskContext.get().partitionId(), 0
    for part in parts:
        n = part.column("n").to_numpy()
        total = before + np.cumsum(n)
        before = int(total[-1]) if len(n) else before
        yield pa.RecordBatch.from_arrays([part.column("_row"), part.column("n"), pa.array(total - n), pa.array(np.full(len(n), part_id))], ["_row", "n", "within", "part"])


def _cut(size: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: list[list] = [[] for _ in range(7)]
            for doc_id, raw, at in zip(part.column("doc_id").to_pylist(), part.column("ids"), part.column("at").to_pylist(), strict=True):
                data = raw.as_buffer()
                total, start = len(data) // 4, 0
                while start < total:
                    sequence, offset = divmod(at + start, size)
                    length = min(size - offset, total - start)
                    for column, value in zip(out, (doc_id, start, length, total, sequence, offset, data[4 * start : 4 * (start + length)].to_pybytes()), strict=True):
                        column.append(value)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], part.column("doc_id").type), *(pa.array(c, pa.int64()) for c in out[1:6]), pa.array(out[6], pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pack(docs: DataFrame, size: int = SEQUENCE, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    A null or empty text is a document of its end id alone. Repeated rows are packed once each, also
    where they share a doc_id. Ties on the curve are broken by the row. Sequences are numbered along the
    curve; all are full but the last. An empty table gives no pieces. Other columns are not read.

    Texts are encoded once and the ids stored in the shared folder; the order is found on the small
    table of keys, and what the driver gets is one total per range of keys.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    coded = stored(rows.mapInArrow(_encode(path, end_id), f"_row long, doc_id {id_type}, ids binary, n long, key long"), "packing-ids", "zstd")
    order = coded.select("_row", "n", "key").repartitionByRange("key", "_row").sortWithinPartitions("key", "_row")
    placed = stored(order.mapInArrow(_running, "_row long, n long, within long, part long"), "packing-order")
    totals = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.sum("n").alias("n")).collect())
    base, at = [], 0
    for part, n in totals:
        base.append((part, at))
        at += n
    bases = docs.sparkSession.createDataFrame(base, "part long, base long")  # one row per range
    placed = placed.join(F.broadcast(bases), "part").select("_row", (F.col("base") + F.col("within")).alias("at"))
    pieces = coded.select("_row", "doc_id", "ids").join(placed, "_row").select("doc_id", "ids", "at")
    return pieces.mapInArrow(_cut(size), f"doc_id {id_type}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
