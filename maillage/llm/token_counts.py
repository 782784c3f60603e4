"""Token counts of whole texts by a two-tier lookup on the map side.

Pre-tokens (what the tokenizer splits a text into before it merges) are found for a whole batch by array
operations on character classes, which the driver asks the tokenizer file itself for. Each pre-token has a
64-bit hash. The first tier is a compact hash table of frequent pre-tokens and their numbers of tokens, made
once and broadcast; what it lacks is looked up in, and learned by, the worker's own cache, so that a worker
encodes a rare pre-token once. No pre-token of the table is shuffled, and no result depends on what either
tier holds.

A text with a special string of the file, or with a character beyond ``CLASSED``, is counted by the tokenizer.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from maillage.llm.bpe import SAFE, pretoken_starts
from maillage.llm.text import Texts, batches, prefix_sums, windows

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
# The first tier: entries, and rows of the sample it is made from. Neither decides a result.
FREQUENT, SAMPLE_ROWS = 1 << 16, 2000
CACHED = 1 << 20  # pre-tokens in a worker's cache; then it starts anew
CLASSED = 0x20000  # code points whose class is asked for: all but rare ideographs
# One character of each class below SAFE that has no part in contractions: letter, digit, other, white space.
_LIKE = (0xE9, 0xB2, 0xA7, 0x85)


@lru_cache(4)
def _tokenizer(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _lengths(tokenizer: Tokenizer, strings: list[str]) -> np.ndarray:
    return np.fromiter((len(e.ids) for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)), np.int64, len(strings))


@lru_cache(4)
def folding(path: str) -> np.ndarray:
    """Per code point below CLASSED a character that the pre-tokenizer treats alike and ``pretoken_starts`` knows.

    A character belongs to a class if the pre-tokenizer does not begin a piece with it after one of that class.
    """
    split = _tokenizer(path).pre_tokenizer.pre_tokenize_str
    out = np.arange(CLASSED, dtype=np.uint32)
    asked = np.array([c for c in range(SAFE, CLASSED) if not 0xD800 <= c <= 0xDFFF])
    kind = np.full(len(asked), _LIKE[3], np.uint32)
    for lead, like in (("\n!a", _LIKE[0]), ("\na!", _LIKE[2]), ("\n!1", _LIKE[1])):
        pieces = split("".join(f"{lead}{chr(c)}" for c in asked.tolist()))
        begins = np.zeros(4 * len(asked) + 1, bool)
        begins[[span[0] for _, span in pieces]] = True
        kind[~begins[3 : 4 * len(asked) : 4]] = like
    out[asked] = kind
    return out


@dataclass(frozen=True)
class FrequentLengths:
    """Open-addressed table of 64-bit hashes: at most half full, so a chain of occupied slots stays short."""

    keys: np.ndarray  # uint64 per slot; 0 is an empty one
    lengths: np.ndarray  # uint16 per slot
    probes: int  # longest chain

    @classmethod
    def build(cls, keys: np.ndarray, lengths: np.ndarray) -> FrequentLengths:
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        table, values, probes = np.zeros(size, np.uint64), np.zeros(size, np.uint16), 0
        for key, length in zip(keys.tolist(), lengths.tolist(), strict=True):
            at, steps = key & (size - 1), 1
            while table[at]:
                at, steps = (at + 1) & (size - 1), steps + 1
            table[at], values[at], probes = key, length, max(probes, steps)
        return cls(table, values, probes)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Length of each key, -1 for those the table lacks."""
        mask = len(self.keys) - 1
        out = np.full(len(keys), -1, np.int64)
        open_, at = np.arange(len(keys)), (keys & np.uint64(mask)).astype(np.int64)
        for _ in range(self.probes):
            found = self.keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.lengths[at[hit]]
            go_on = ~hit & (found != 0)
            open_, at = open_[go_on], (at[go_on] + 1) & mask
            if not len(open_):
                break
        return out


_known: dict[str, dict[int, int]] = {}  # per file: hash to length, of what this worker has encoded


class Counter:
    def __init__(self, path: str, fold: np.ndarray, frequent: FrequentLengths | None = None):
        self.path, self.fold, self.frequent = path, fold, frequent
        self.tokenizer = _tokenizer(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _known.setdefault(path, {})

    def plain(self, texts: Texts) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(rows that need the tokenizer, code points of the others end to end, bounds of all rows in them)."""
        odd = [k for k in range(texts.n) if self._odd(texts.data[texts.bounds[k] : texts.bounds[k + 1]])]
        data, sizes = texts.data, np.diff(texts.bounds)
        if odd:
            keep = np.ones(len(data), bool)
            for k in odd:
                keep[texts.bounds[k] : texts.bounds[k + 1]] = False
                sizes[k] = 0
            data = data[keep]
        cp = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[np.concatenate(([0], np.cumsum(sizes)))]
        return odd, cp, chars

    def _odd(self, data: np.ndarray) -> bool:
        # 0xF0 with a second byte from 0xA0, or a first byte above it, begins a character from CLASSED on.
        high = np.flatnonzero(data >= 0xF0)
        if len(high) and (data[high].max() > 0xF0 or data[high + 1].max() >= 0xA0):
            return True
        raw = data.tobytes()
        return any(s in raw for s in self.special)

    def pretokens(self, cp: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, hashes) of the pre-tokens."""
        starts = pretoken_starts(self.fold[cp], np.unique(chars[:-1][np.diff(chars) > 0]))
        ends = np.append(starts[1:], len(cp)) if len(starts) else starts
        return starts, ends, windows(prefix_sums(cp), starts, ends)

    def encode_missing(self, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Lengths of distinct pre-tokens by the worker's cache, which learns those it has not met."""
        if len(self.known) > CACHED:
            self.known.clear()
        lengths = np.fromiter((self.known.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(lengths < 0)
        if len(new):
            lengths[new] = _lengths(self.tokenizer, [cp[a:b].tobytes().decode("utf-32-le") for a, b in zip(starts[new], ends[new], strict=True)])
            self.known.update(zip(keys[new].tolist(), lengths[new].tolist(), strict=True))
        return lengths

    def count(self, texts: Texts) -> np.ndarray:
        odd, cp, chars = self.plain(texts)
        starts, ends, keys = self.pretokens(cp, chars)
        lengths = self.frequent.look_up(keys) if self.frequent else np.full(len(keys), -1, np.int64)
        missing = np.flatnonzero(lengths < 0)
        if len(missing):
            distinct, first, inverse = np.unique(keys[missing], return_index=True, return_inverse=True)
            at = missing[first]
            lengths[missing] = self.encode_missing(cp, starts[at], ends[at], distinct)[inverse]
        total = np.concatenate(([0], np.cumsum(lengths)))
        of_row = np.searchsorted(starts, chars)
        out = total[of_row[1:]] - total[of_row[:-1]]
        for k in odd:
            out[k] = len(self.tokenizer.encode(texts.data[texts.bounds[k] : texts.bounds[k + 1]].tobytes().decode(), add_special_tokens=False).ids)
        return out


def frequent_lengths(docs: DataFrame, path: str, fold: np.ndarray, entries: int = FREQUENT, sample_rows: int = SAMPLE_ROWS) -> FrequentLengths:
    """Table of the pre-tokens most frequent in a random sample of about ``sample_rows`` rows, drawn over the whole table.

    Counts are summed per task and then by hash; the driver gets ``entries`` rows at most.
    """

    def tally(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, fold)
        for part in parts:
            for texts in batches(part.column(0)):
                _, cp, chars = counter.plain(texts)
                starts, ends, keys = counter.pretokens(cp, chars)
                distinct, first, n = np.unique(keys, return_index=True, return_counts=True)
                lengths = counter.encode_missing(cp, starts[first], ends[first], distinct)
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(n), pa.array(lengths)], ["key", "n", "tokens"])

    rows = docs.select("text").where(F.length("text") > 0)
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = rows if share == 1.0 else rows.sample(share, seed=13)
    counts = sample.mapInArrow(tally, "key long, n long, tokens long").groupBy("key").agg(F.sum("n").alias("n"), F.max("tokens").alias("tokens"))
    fits = (F.col("key") != 0) & (F.col("tokens") < 1 << 16)
    top = counts.where(fits).orderBy(F.col("n").desc(), "key").limit(entries).select("key", "tokens").collect()
    keys, tokens = (np.array([r[c] for r in top], np.int64) for c in ("key", "tokens"))
    return FrequentLengths.build(keys.view(np.uint64), tokens)


def token_count(path: str, fold: np.ndarray, frequent: FrequentLengths | None, text: Column) -> Column:
    """Number of tokens of a text; a null text has none."""

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        counter = Counter(path, fold, frequent)
        return pa.array(np.concatenate([np.zeros(0, np.int64), *(counter.count(texts) for texts in batches(column))]))

    return count(text)


def count_tokens(docs: DataFrame, limit: int = LIMIT, tokenizer: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens as the tokenizer library gives them, over_limit.

    Begin, end or padding tokens are not added and nothing is cut; a special string inside a text is the special
    token, which is the library's default. A null or empty text has no bytes and no tokens. Repeated rows are
    counted once each; an empty table gives an empty result. Other columns are not read. The file's
    pre-tokenizer must be that of byte-level pair encoding.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    fold = folding(path)
    frequent = frequent_lengths(docs, path, fold)
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    counted = docs.select("doc_id", n_bytes, token_count(path, fold, frequent, F.col("text")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
