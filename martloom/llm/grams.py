"""Hashed byte n-grams of lower-cased text, computed on whole arrays."""

from __future__ import annotations

import numpy as np

_LETTERS = b"abcdefghijklmnopqrstuvwxyz"
LETTERS_ONLY = bytes(c if c > 127 or c in _LETTERS else 32 for c in range(256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64, a fixed public mixing function."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_buckets(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A bucket below 2**bits for each run of `n` <= 7 bytes of a uint8 array."""
    if len(data) < n:
        return np.zeros(0, dtype=np.int64)
    packed = np.zeros(len(data) - n + 1, dtype=np.uint64)
    for at in range(n):
        packed <<= np.uint64(8)
        packed |= data[at : at + len(packed)]
    packed += np.uint64(n << 56)
    packed *= MULTIPLIER
    packed ^= packed >> np.uint64(32)
    packed *= MULTIPLIER
    return (packed >> np.uint64(64 - bits)).astype(np.int64)


def word_buckets(data: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and bucket of each run of bytes above 32 (a word, in text prepared for it).

    A word's hash is a polynomial in its bytes: a difference of running sums, divided by the power
    at its start. All is modulo 2**64, where an odd base has an inverse.
    """
    edges = np.diff(np.concatenate([[False], data > 32, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return starts, starts
    inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
    powers = np.cumprod(np.full(len(data), MULTIPLIER, dtype=np.uint64))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(powers * (data + np.uint64(1)))])
    back = np.cumprod(np.full(len(data), inverse, dtype=np.uint64))[starts]
    hashed = (running[ends] - running[starts]) * back
    hashed ^= hashed >> np.uint64(32)
    hashed *= MULTIPLIER
    return starts, (hashed >> np.uint64(64 - bits)).astype(np.int64)
