"""Keyed pseudorandom permutations of 0..n-1: a balanced Feistel network with cycle walking, vectorised."""

from __future__ import annotations

import numpy as np

from .common import mix64

ROUNDS = 6


def key_of(*parts: int) -> int:
    """A 64-bit key from small integers."""
    k = np.zeros(1, np.uint64)
    for p in parts:
        k = mix64(k ^ np.uint64(p % 2**64))
    return int(k[0])


def _half_bits(n: np.ndarray) -> np.ndarray:
    values, where = np.unique(n, return_inverse=True)
    half = np.array([(max(int(v) - 1, 0).bit_length() + 1) // 2 for v in values], np.uint64)
    return half[where]


def _network(x: np.ndarray, half: np.ndarray, key: np.ndarray, rounds: range) -> np.ndarray:
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    if rounds.step > 0:
        for r in rounds:
            left, right = right, left ^ (mix64(right ^ mix64(key + np.uint64(r))) & mask)
    else:
        for r in rounds:
            left, right = right ^ (mix64(left ^ mix64(key + np.uint64(r))) & mask), left
    return (left << half) | right


def _walk(x, n, key, rounds: range) -> np.ndarray:
    x = np.atleast_1d(np.asarray(x, np.uint64)).copy()
    n = np.broadcast_to(np.asarray(n, np.uint64), x.shape)
    key = np.broadcast_to(np.asarray(key, np.uint64), x.shape)
    if len(x) and not (x < n).all():
        raise ValueError("a value is outside the permutation's domain")
    half, todo = _half_bits(n), np.arange(len(x))
    with np.errstate(over="ignore"):
        while len(todo):  # a value outside the domain is permuted again until it falls inside
            x[todo] = _network(x[todo], half[todo], key[todo], rounds)
            todo = todo[x[todo] >= n[todo]]
    return x


def permute(x, n, key) -> np.ndarray:
    """Where the permutation of 0..n-1 under ``key`` sends ``x``; n and key may differ from row to row."""
    return _walk(x, n, key, range(ROUNDS))


def unpermute(x, n, key) -> np.ndarray:
    return _walk(x, n, key, range(ROUNDS - 1, -1, -1))
