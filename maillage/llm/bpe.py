"""Byte-level BPE ids of whole texts, equal to those of the tokenizer file, with each distinct pre-token encoded once.

The pre-tokens (a contraction; letters, digits or other characters with the space before them; white
space) are found for a whole batch by array operations on character classes. They are hashed, and only
pre-tokens that this worker has not met are given to the tokenizer. Classes are taken from the given
Unicode data for the characters below ``SAFE``; a text with any other character, or with a special
token of the file, is encoded by the tokenizer itself.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from maillage.llm.id_cache import IdCache
from maillage.llm.text import BATCH_BYTES, Texts, batches, prefix_sums, windows

SAFE = 0x500  # Latin, Greek, Cyrillic: every character whose bytes are at most 0xD3
LETTER, DIGIT, OTHER, SPACE = 1, 2, 3, 4
# Unicode White_Space below SAFE, fixed values.
_SPACES = (9, 10, 11, 12, 13, 32, 0x85, 0xA0)
# Endings of contractions after an apostrophe, fixed values of the pre-tokenizer.
_ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


@lru_cache(1)
def _classes() -> np.ndarray:
    out = np.full(SAFE, OTHER, np.uint8)
    for cp in range(SAFE):
        kind = unicodedata.category(chr(cp))[0]
        out[cp] = LETTER if kind == "L" else DIGIT if kind == "N" else OTHER
    out[list(_SPACES)] = SPACE
    return out


def pretoken_starts(cp: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin. ``cp``: code points below SAFE of texts that begin at ``starts`` (sorted, no empty text)."""
    if not len(cp):
        return np.zeros(0, np.int64)
    kind = _classes()[cp]
    first = np.zeros(len(cp), bool)
    first[starts] = True
    last = np.zeros(len(cp), bool)  # last character of a text
    last[starts[1:] - 1] = True
    last[-1] = True
    begin = first.copy()
    begin[1:] |= (kind[1:] != kind[:-1]) & (cp[:-1] != 32)
    space = kind == SPACE
    # The last of several white-space characters stands apart when a text goes on after them.
    inner = space[1:-1] & space[:-2] & ~space[2:] & ~first[1:-1] & ~last[1:-1]
    begin[1:-1] |= inner
    # Contractions: an apostrophe that no space leads in, then an ending.
    quote = np.flatnonzero((cp == 39) & begin & ~last)
    quote = quote[(quote == 0) | first[quote] | (cp[quote - 1] != 32)]
    padded = np.concatenate((cp, np.zeros(2, cp.dtype)))
    done = np.zeros(len(quote), bool)
    for ending in _ENDINGS:
        size = len(ending)
        fits = ~done & np.all([padded[quote + 1 + k] == ord(c) for k, c in enumerate(ending)], axis=0)
        if size == 2:
            fits &= ~last[np.minimum(quote + 1, len(cp) - 1)]
        done |= fits
        begin[quote[fits] + 1] = False
        after = quote[fits] + 1 + size
        begin[after[after < len(cp)]] = True
    return np.flatnonzero(begin)


class Encoder:
    """Ids of batches of texts. One per worker and file; remembers the pre-tokens it has met."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = IdCache()

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's own)."""
        plain = np.array([self._plain(texts.data[a:b]) for a, b in zip(texts.bounds[:-1], texts.bounds[1:], strict=True)], bool)
        if plain.all():
            return self._encode_plain(texts.data, texts.bounds)
        ids, sizes = [], []
        for k in range(texts.n):
            piece = texts.data[texts.bounds[k] : texts.bounds[k + 1]]
            if plain[k]:
                one, _ = self._encode_plain(piece, np.array([0, len(piece)]))
            else:
                one = np.asarray(self.tokenizer.encode(piece.tobytes().decode(), add_special_tokens=False).ids, np.uint32)
            ids.append(one)
            sizes.append(len(one))
        return np.concatenate(ids), np.concatenate(([0], np.cumsum(sizes)))

    def _plain(self, data: np.ndarray) -> bool:
        # Bytes up to 0xD3 begin characters below SAFE; special tokens are looked for as bytes.
        if len(data) and data.max() > 0xD3:
            return False
        raw = data.tobytes()
        return not any(s.encode() in raw for s in self.special)

    def _encode_plain(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cp = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[bounds]  # text bounds in characters
        starts = pretoken_starts(cp, np.unique(chars[:-1][np.diff(chars) > 0]))
        ends = np.append(starts[1:], len(cp))
        hashes = windows(prefix_sums(cp), starts, ends)
        keys, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        self.cache.make_room(len(keys))
        new = np.flatnonzero(~self.cache.known(keys))
        if len(new):
            strings = [cp[starts[w] : ends[w]].tobytes().decode("utf-32-le") for w in where[new]]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
            self.cache.learn(keys[new], np.fromiter((i for x in found for i in x), np.uint32), np.array([len(x) for x in found]))
        ids, total = self.cache.gather(self.cache.slots_of(keys)[inverse])
        return ids, total[np.searchsorted(starts, chars)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_column(path: str, column: pa.Array, limit: int = BATCH_BYTES):
    """For runs of texts: (first row, ids, offsets of each text's own). A null text has no ids."""
    own = encoder(path)
    for texts in batches(column, limit):
        yield texts.lo, *own.encode(texts)
