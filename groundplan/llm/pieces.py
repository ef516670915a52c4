"""Token ids of whole texts, by encoding each distinct unit of text once.

A unit is a stretch of bytes whose ids don't depend on its surroundings. Units are looked up by 64-bit hashes in a bounded
cache of each Python worker; only new ones reach the encoder. Two different units get one hash with a probability of about
2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

MAX_UNITS = 600_000
MAX_IDS = 4_000_000


class UnitCache:
    """Ids of units; emptied when it holds more than MAX_UNITS units or MAX_IDS ids."""

    def __init__(self, encode: Callable[[list[bytes]], Sequence[Sequence[int]]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)  # ascending
        self.slots = np.empty(0, np.int32)
        self.ids = np.empty(1 << 16, np.int32)
        self.offs = np.zeros(1 << 12, np.int64)

    def _append(self, new: Sequence[Sequence[int]], hashes: np.ndarray) -> None:
        """Add units with ascending hashes that aren't there yet."""
        n = len(self.keys)
        sizes = np.fromiter((len(x) for x in new), np.int64, len(new))
        top = self.offs[n] + np.cumsum(sizes)
        while len(self.offs) < n + len(new) + 1:
            self.offs = np.concatenate([self.offs, np.zeros_like(self.offs)])
        self.offs[n + 1 : n + 1 + len(new)] = top
        while len(self.ids) < top[-1]:
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.offs[n] : top[-1]] = np.concatenate([np.asarray(x, np.int32) for x in new])
        at = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, at, hashes)
        self.slots = np.insert(self.slots, at, np.arange(n, n + len(new), dtype=np.int32))

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units one after the other, and how many each unit has."""
        if len(self.keys) > MAX_UNITS or self.offs[len(self.keys)] > MAX_IDS:
            self.clear()
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == distinct[known]
        new = first[~known]
        if len(new):
            self._append(self.encode([data[a:b].tobytes() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]), distinct[~known])
        slots = self.slots[np.searchsorted(self.keys, distinct)][which]
        sizes = self.offs[slots + 1] - self.offs[slots]
        return gather(self.ids, self.offs[slots], sizes), sizes


def gather(store: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of store one after the other."""
    before = np.cumsum(sizes) - sizes
    return store[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
