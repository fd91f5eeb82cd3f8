"""Minimal perfect hashing of 128-bit signatures: levels of bit arrays, in which a key's slot is the rank of its bit."""

from __future__ import annotations

import numpy as np

from .common import mix64

#: Bits between stored ranks.
STEP = 512
#: With two bits for each key that is left, some 40 % are left by each level; only equal signatures stay beyond this many.
MOST_LEVELS = 128


def _places(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix64(h1 ^ mix64(h2 + np.uint64(level))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0..n-1 for n distinct pairs of 64-bit hashes; other pairs get some slot or none (-1).

    A level has two bits for each key left to place; a bit is set where exactly one key falls, and the others go to the
    next level. So a lookup reads one bit of each of two levels on average, whatever n is, and counts set bits over at
    most ``STEP`` of them.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits, self.sizes = bits, sizes
        self.first = np.cumsum(sizes) - sizes
        per_step = np.add.reduceat(np.bitwise_count(bits).astype(np.int64), np.arange(0, len(bits), STEP // 8)) if len(bits) else np.zeros(0, np.int64)
        self.rank = np.cumsum(per_step) - per_step
        self.n = int(per_step.sum())

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        parts, sizes, left = [], [], np.arange(len(h1))
        with np.errstate(over="ignore"):
            while len(left):
                if len(sizes) == MOST_LEVELS:
                    raise ValueError("two keys have the same hashes")
                size = -(-2 * len(left) // STEP) * STEP
                at = _places(h1[left], h2[left], len(sizes), size)
                alone = np.bincount(at, minlength=size) == 1
                parts.append(np.packbits(alone, bitorder="little"))
                sizes.append(size)
                left = left[~alone[at]]
        return cls(np.concatenate([np.zeros(0, np.uint8), *parts]), np.array(sizes, np.int64))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out, left = np.full(len(h1), -1), np.arange(len(h1))
        with np.errstate(over="ignore"):
            for level, (first, size) in enumerate(zip(self.first, self.sizes)):
                if not len(left):
                    break
                at = first + _places(h1[left], h2[left], level, int(size))
                hit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                out[left[hit]] = self._ranks(at[hit])
                left = left[~hit]
        return out

    def _ranks(self, at: np.ndarray) -> np.ndarray:
        """How many set bits stand before each place."""
        step, byte = at // STEP, np.arange(STEP // 8)
        before = byte < (at % STEP >> 3)[:, None]
        whole = np.zeros(len(at), np.int64)
        for a in range(0, len(at), 4096):  # bounds what the rows of a step take
            rows = self.bits[step[a : a + 4096, None] * (STEP // 8) + byte]
            whole[a : a + 4096] = (np.bitwise_count(rows) * before[a : a + 4096]).sum(1)
        below = np.bitwise_count(self.bits[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8))
        return self.rank[step] + whole + below
