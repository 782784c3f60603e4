"""Bytes of whole texts as numpy arrays: words, rolling hashes, batches of bounded size.

A rolling hash here is a sum of (byte + 1) times a power of an odd number, modulo 2**64. The hash of
any window is a difference of two prefix sums times the inverse power, so all windows of a batch cost
a few array operations, and no loop runs over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 20  # texts handled together; one longer text makes a batch of its own

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

# White space of the contracts: 0x20 and 0x09 to 0x0D.
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

# A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse; kept between batches."""
    global _powers
    if len(_powers[0]) <= n:
        size = 1 << int(n).bit_length()
        _powers = tuple(np.concatenate(([_U(1)], np.multiply.accumulate(np.full(size, base, _U)))) for base in (_BASE, _BASE_INVERSE))
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of rolling hashes (two multiply-and-shift rounds)."""
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(32))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    out = np.empty(len(data) + 1, _U)
    out[0] = 0
    np.cumsum((data.astype(_U) + _U(1)) * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def windows(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte windows [start, end)."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


@dataclass
class Texts:
    """Whole texts of some rows: their bytes, and where each text begins and ends."""

    lo: int  # first row in the record batch
    hi: int
    data: np.ndarray  # uint8
    bounds: np.ndarray  # len(rows) + 1 offsets into data

    @property
    def n(self) -> int:
        return self.hi - self.lo

    def words(self, space: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words; a word never crosses two texts."""
        solid = ~(WHITE[self.data] if space is None else space)
        if not len(solid):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.zeros(len(solid) + 1, bool)  # an index at which a text begins
        first[self.bounds] = True
        start, end = solid.copy(), solid.copy()
        start[1:] &= ~solid[:-1] | first[1:-1]
        end[:-1] &= ~solid[1:] | first[1:-1]
        return np.flatnonzero(start), np.flatnonzero(end) + 1

    def rows_of(self, starts: np.ndarray) -> np.ndarray:
        """Offsets into ``starts`` at which each text's own begin (n + 1 values)."""
        return np.searchsorted(starts, self.bounds)


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null text is empty."""
    column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def batches(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[Texts]:
    """Runs of whole texts of about ``limit`` bytes."""
    data, offsets = string_buffer(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1))
        yield Texts(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def sums_by_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets ``rows``; an empty run sums to 0."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[rows[1:]] - total[rows[:-1]]
