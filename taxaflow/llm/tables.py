"""Arrays that operators share: a hash table of integers, and lists laid end to end."""

from __future__ import annotations

import numpy as np

_EMPTY = np.uint64(2**64 - 1)


class IntTable:
    """64-bit keys (not 2^64 - 1) to int32 values by open addressing; read and filled by whole arrays.

    It has room for ``most`` keys and is emptied when more would come, so that its memory stays as it is.
    """

    def __init__(self, most: int):
        self.most, self.n = most, 0
        bits = max(4, int(2 * most).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, _EMPTY), np.zeros(1 << bits, np.int32)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for unknown keys."""
        at = self._first(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.int32(-1))
        todo = np.flatnonzero((held != keys) & (held != _EMPTY))
        at = at[todo]
        while len(todo):
            at = (at + 1) & self.mask
            held = self.keys[at]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            more = ~hit & (held != _EMPTY)
            todo, at = todo[more], at[more]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds keys that are new and distinct; of more than there is room for, the first ones."""
        if self.n + len(keys) > self.most:
            self.keys[:], self.n = _EMPTY, 0
            keys, values = keys[: self.most], values[: self.most]
        self.n += len(keys)
        at = self._first(keys)
        while len(keys):
            free = self.keys[at] == _EMPTY
            self.keys[at[free]] = keys[free]  # where several take one place, one of them has it
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], (at[~won] + 1) & self.mask


def gathered(values: np.ndarray, count: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The lists numbered ``where``, end to end; list i is the ``count[i]`` values after those of the lists before it."""
    first, size = np.cumsum(count) - count, count[where]
    total = int(size.sum())
    if not total:
        return values[:0]
    return values[np.repeat(first[where] - (np.cumsum(size) - size), size) + np.arange(total)]
