"""Words of whole texts as dictionary codes, found by Arrow kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # texts coded together; one longer text makes a slice of its own


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, run of rows) with about ``limit`` bytes of text each; null texts become empty."""
    column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(column):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield lo, column.slice(lo, hi - lo)
        lo = hi


def coded_words(column: pa.Array, separators: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes of all words end to end, where each row's own begin and end, the words that the codes stand for).

    Only A-Z are lower-cased. ``separators`` is a pattern of one or more characters between words. The
    words of the dictionary occur, each of them once; the empty string is no word.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(column), pattern=separators)
    flat = pc.list_flatten(lists)
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))))
    solid = pc.not_equal(flat, "")
    bounds = np.concatenate(([0], np.cumsum(solid.to_numpy(zero_copy_only=False))))[bounds]
    coded = flat.filter(solid).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds, coded.dictionary


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Exact sums of integers between consecutive bounds; an empty run sums to 0."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]
