"""SentencePiece encoding and decoding by suffix-array matching.

The distinct stretches of a batch (white space and what follows it; no piece reaches across) are laid
end to end and indexed by a suffix array to the depth of the longest piece. Every piece of the
vocabulary is found in it by binary search, all pieces at once and one character deeper a round; the
places in its range are edges of the text. Edges are sorted by position, and every stretch is relaxed
along them: as the model is a byte-pair one, its best pair of neighbouring symbols that an edge spans
is joined until none is left, of equal scores the leftmost. Characters without a piece become byte
pieces. Ids equal those of the library for the same file; the library itself only lists the pieces.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.llm.id_cache import IdCache, pick
from maillage.llm.text import batches, prefix_sums, string_buffer, windows

MODEL = "piece_bpe_32k.model"
MARK = 0x2581  # stands for a space, fixed by the format
INDEX_CHARS = 500_000  # characters indexed together; one longer stretch makes an index of its own
LONG = 64  # characters above which a stretch is relaxed with a heap, on its own
NONE = -1


class Vocabulary:
    """Pieces of a model file: code points, scores, byte pieces, and the bytes each id decodes to."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces, self.byte_ids, self.scores = {}, np.zeros(256, np.int64), np.zeros(model.get_piece_size())
        raw = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.scores[i] = model.get_score(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                raw.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                raw.append(b"")
            else:
                self.pieces[piece] = i
                raw.append(piece.replace(chr(MARK), " ").encode())
        self.depth = max(map(len, self.pieces))
        self.crossing = any(chr(MARK) in p.lstrip(chr(MARK)) for p in self.pieces)
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        self.ids = np.array(list(self.pieces.values()))
        self.lengths = np.array([len(p) for p in self.pieces])
        self.codes = np.zeros((len(self.pieces), self.depth), np.uint32)
        for k, p in enumerate(self.pieces):
            self.codes[k, : len(p)] = [ord(c) for c in p]


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` codes that follow, by doubling; past the end counts as smallest."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while width < depth:
        after = np.zeros_like(rank)
        after[:-width] = rank[width:] if width < len(rank) else 0
        rank = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        width *= 2
    return np.argsort(rank, kind="stable")


def _bound(column: np.ndarray, order: np.ndarray, k: int, lo: np.ndarray, hi: np.ndarray, code: np.ndarray, right: bool) -> np.ndarray:
    """For every range [lo, hi) of the suffix array: where ``code`` belongs among the k-th characters."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        middle = (lo + hi) >> 1
        seen = column[order[np.where(open_, middle, 0)] + k]
        up = open_ & ((seen <= code) if right else (seen < code))
        lo = np.where(up, middle + 1, lo)
        hi = np.where(open_ & ~up, middle, hi)


def occurrences(codes: np.ndarray, order: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the vocabulary's codes, first, last + 1 in the suffix array) of every piece that occurs."""
    padded = np.concatenate((codes, np.zeros(vocabulary.depth, codes.dtype)))
    present = np.unique(codes)
    row = np.arange(len(vocabulary.ids))
    fits = np.isin(vocabulary.codes, present) | (np.arange(vocabulary.depth) >= vocabulary.lengths[:, None])
    row = row[fits.all(1)]
    lo, hi = np.zeros(len(row), np.int64), np.full(len(row), len(order))
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k in range(vocabulary.depth):
        code = vocabulary.codes[row, k]
        lo, hi = _bound(padded, order, k, lo, hi, code, False), _bound(padded, order, k, lo, hi, code, True)
        found = lo < hi
        row, lo, hi = row[found], lo[found], hi[found]
        ended = vocabulary.lengths[row] == k + 1
        done.append((row[ended], lo[ended], hi[ended]))
        row, lo, hi = row[~ended], lo[~ended], hi[~ended]
    return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def edges(codes: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Id of the piece from each position with each length (NONE: no such piece), a row a position."""
    order = suffix_array(codes, vocabulary.depth)
    row, lo, hi = occurrences(codes, order, vocabulary)
    size = hi - lo
    place = order[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - lo, size)]
    key = (place * vocabulary.depth + np.repeat(vocabulary.lengths[row] - 1, size)) << 20 | np.repeat(vocabulary.ids[row], size)
    key.sort()  # by position, then length
    table = np.full(len(codes) * vocabulary.depth, NONE, np.int32)
    table[key >> 20] = key & 0xFFFFF
    return table.reshape(len(codes), vocabulary.depth)


def relax(table: np.ndarray, scores: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Beginnings of the final symbols of all stretches [start, end), sorted.

    A round joins the best pair of every stretch that still has one.
    """
    depth = table.shape[1]
    short = ends - starts <= LONG
    finished = [_relax_one(table, scores, int(a), int(b)) for a, b in zip(starts[~short], ends[~short], strict=True)]
    starts, ends = starts[short], ends[short]
    size = ends - starts
    own = np.repeat(np.arange(len(starts)), size)  # stretch of each symbol
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - starts, size)
    while len(at):
        # The pair of symbol k and the one after it ends where the symbol after that begins.
        after = np.append(at[1:], 0)
        last = np.append(own[1:] != own[:-1], True)
        stop = np.where(last, ends[own], after)
        pair_stop = np.append(stop[1:], 0)
        length = pair_stop - at
        able = ~last & (length <= depth)
        piece = np.full(len(at), NONE, np.int64)
        piece[able] = table[at[able], length[able] - 1]
        able = piece >= 0
        value = np.where(able, scores[piece], -np.inf)
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        best = np.maximum.reduceat(value, first)
        going = best > -np.inf
        here = np.repeat(going, np.diff(np.append(first, len(at))))
        finished.append(at[~here])
        # The leftmost symbol of each stretch that has the best value takes the next one in.
        hit = np.flatnonzero(here & (value == np.repeat(best, np.diff(np.append(first, len(at))))))
        hit = hit[np.unique(own[hit], return_index=True)[1]]
        keep = here
        keep[hit + 1] = False
        at, own = at[keep], own[keep]
    return np.sort(np.concatenate(finished)) if finished else np.zeros(0, np.int64)


def _relax_one(table: np.ndarray, scores: np.ndarray, start: int, end: int) -> np.ndarray:
    """The same for one long stretch, with a heap of pairs."""
    depth = table.shape[1]
    n = end - start
    after, before, stop, alive = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap: list[tuple[float, int, int]] = []

    def push(k: int) -> None:
        if k >= 0 and after[k] < n:
            size = stop[after[k]] - k
            if size <= depth and (piece := table[start + k, size - 1]) >= 0:
                heapq.heappush(heap, (-scores[piece], k, size))

    for k in range(n):
        push(k)
    while heap:
        _, k, size = heapq.heappop(heap)
        if not alive[k] or after[k] >= n or stop[after[k]] - k != size:
            continue  # one of the two has been joined elsewhere
        gone = after[k]
        alive[gone] = False
        stop[k], after[k] = stop[gone], after[gone]
        if after[k] < n:
            before[after[k]] = k
        push(k)
        push(before[k])
    return start + np.flatnonzero(alive)


class PieceEncoder:
    """One per worker and model file; remembers the stretches it has met."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.cache = IdCache()

    def stretches(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code points with marks, stretch starts, ends, offsets of each text's stretches)."""
        cp = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[bounds]
        filled = np.flatnonzero(np.diff(chars) > 0)
        marked = np.insert(cp, chars[filled], 32)  # the mark that leads in every text that is not empty
        marked = np.where(marked == 32, np.uint32(MARK), marked)
        chars = chars + np.concatenate(([0], np.cumsum(np.diff(chars) > 0)))
        begin = np.zeros(len(marked), bool)
        begin[chars[filled]] = True
        if not self.vocabulary.crossing:
            begin[1:] |= (marked[1:] == MARK) & (marked[:-1] != MARK)
        starts = np.flatnonzero(begin)
        return marked, starts, np.append(starts[1:], len(marked)), np.searchsorted(starts, chars)

    def learn(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        v = self.vocabulary
        table = edges(codes, v)
        at = relax(table, v.scores, starts, ends)
        stop = np.append(at[1:], len(codes))
        ids = table[at, np.minimum(stop - at, v.depth) - 1].astype(np.int64)
        which = np.searchsorted(starts, at, side="right") - 1
        bare = np.flatnonzero(ids < 0)  # single characters without a piece
        if len(bare):
            raw = [chr(c).encode() for c in codes[at[bare]]]
            count = np.ones(len(ids), np.int64)
            count[bare] = [len(r) for r in raw]
            places = np.cumsum(count) - count
            out = np.repeat(ids, count)
            inserted = v.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
            out[np.repeat(places[bare] - (np.cumsum(count[bare]) - count[bare]), count[bare]) + np.arange(len(inserted))] = inserted
            ids, which = out, np.repeat(which, count)
        self.cache.learn(keys, ids, np.bincount(which, minlength=len(starts)))

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For runs of texts: (first row, ids, offsets of each text's own). A null text has no ids."""
        waiting: list = []
        pending, pending_keys, pending_chars = [], np.zeros(0, np.uint64), 0

        def settle() -> None:
            nonlocal pending, pending_keys, pending_chars
            if pending:
                size = np.array([len(p) for p in pending])
                stop = np.cumsum(size)
                self.learn(np.concatenate(pending), stop - size, stop, pending_keys)
                pending, pending_keys, pending_chars = [], np.zeros(0, np.uint64), 0

        def ready() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for lo, hashes, rows in waiting:
                ids, total = self.cache.gather(self.cache.slots_of(hashes))
                yield lo, ids, total[rows]
            waiting.clear()

        for texts in batches(column):
            marked, starts, ends, rows = self.stretches(texts.data, texts.bounds)
            hashes = windows(prefix_sums(marked), starts, ends)
            keys, where = np.unique(hashes, return_index=True)
            if len(self.cache.keys) + len(pending) + len(keys) > self.cache.limit:
                settle()
                yield from ready()
                self.cache.forget()
            fresh = ~self.cache.known(keys) & ~np.isin(keys, pending_keys)
            pending.extend(marked[starts[w] : ends[w]] for w in where[fresh])
            pending_keys = np.concatenate((pending_keys, keys[fresh]))
            pending_chars += int((ends - starts)[where[fresh]].sum())
            waiting.append((texts.lo, hashes, rows))
            if pending_chars > INDEX_CHARS:
                settle()
                yield from ready()
        settle()
        yield from ready()

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> list[bytes]:
        """Bytes of every text; the space that leads in a text is taken off."""
        v = self.vocabulary
        raw, total = pick(v.raw, v.raw_offsets, ids)
        whole, bounds = raw.tobytes(), total[rows]
        return [whole[a + (b > a and whole[a] == 32) : b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _path(model: str | None) -> str:
    return model or public_tokenizers.path(MODEL)


def encode_pieces(text: Column, model: str | None = None) -> Column:
    """Array of piece ids of a text; empty for a null or empty text."""
    path = _path(model)

    def run(column: pa.Array) -> pa.Array:
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for _, own, rows in encoder(path).encode(column):
            ids.append(own.astype(np.int32))
            sizes.append(np.diff(rows))
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))

    return F.arrow_udf(run, "array<int>")(text)


def decode_pieces(ids: Column, model: str | None = None) -> Column:
    """Text of an array of piece ids; bytes that are no UTF-8 become replacement characters. A null array gives an empty text."""
    path = _path(model)

    def run(column: pa.Array) -> pa.Array:
        out = []
        for own in column:
            values = own.values.to_numpy(zero_copy_only=False) if own.is_valid else np.zeros(0, np.int64)
            out.extend(encoder(path).decode(values.astype(np.int64), np.array([0, len(values)])))
        return pa.array([x.decode(errors="replace") for x in out], pa.string())

    return F.arrow_udf(run, "string")(ids)


def _round_trip(path: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in parts:
            data, offsets = string_buffer(part.column("text"))
            for lo, ids, rows in own.encode(part.column("text")):
                n = len(rows) - 1
                decoded = own.decode(ids.astype(np.int64), rows)
                packed = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").slice(lo, n), pa.array(np.diff(rows)), pa.array([packed[a:b].tobytes() for a, b in zip(rows[:-1], rows[1:], strict=True)], pa.binary()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                    pa.array([x == data[offsets[lo + k] : offsets[lo + k + 1]].tobytes() for k, x in enumerate(decoded)]),
                ], ["doc_id", "n_ids", "ids", "decoded_sha256", "round_trip"])

    return run


def code_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per row: doc_id, n_ids, ids (little-endian unsigned 32-bit), decoded_sha256, round_trip.

    Every whole text is encoded and decoded again. A null or empty text has no ids and decodes to an
    empty text. Only a text that holds the mark itself (U+2581) does not come back as it was: the mark
    decodes to a space. Repeated rows are coded once each; other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_round_trip(_path(model)), f"doc_id {kind}, n_ids long, ids binary, decoded_sha256 string, round_trip boolean")
