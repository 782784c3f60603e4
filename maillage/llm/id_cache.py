"""Ids of strings a worker has met, found by 64-bit hash for whole arrays at once."""

from __future__ import annotations

import numpy as np

LIMIT = 1_000_000  # strings; then the memory starts anew


class IdCache:
    def __init__(self, limit: int = LIMIT):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.slots = np.zeros(0, np.int64)
        self.offsets = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def make_room(self, n: int) -> None:
        if len(self.keys) and len(self.keys) + n > self.limit:
            self.forget()

    def known(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        out = at < len(self.keys)
        out[out] = self.keys[at[out]] == keys[out]
        return out

    def learn(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """``ids`` of all strings end to end, ``sizes`` how many each has; the keys are new."""
        slots = len(self.offsets) - 1 + np.arange(len(keys))
        self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(sizes)))
        self.ids = np.concatenate((self.ids, ids.astype(np.uint32)))
        both = np.concatenate((self.keys, keys))
        order = np.argsort(both, kind="stable")
        self.keys = both[order]
        self.slots = np.concatenate((self.slots, slots))[order]

    def slots_of(self, keys: np.ndarray) -> np.ndarray:
        return self.slots[np.searchsorted(self.keys, keys)] if len(keys) else np.zeros(0, np.int64)

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings end to end, and the offsets at which each string's begin."""
        return pick(self.ids, self.offsets, slots)


def pick(values: np.ndarray, offsets: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the chosen runs end to end, and where each run begins in the result."""
    size = offsets[slots + 1] - offsets[slots]
    total = np.concatenate(([0], np.cumsum(size)))
    place = np.arange(total[-1]) - np.repeat(total[:-1] - offsets[slots], size)
    return values[place], total
