"""Hashed byte n-grams, words and word beginnings of a batch of texts, all in numpy."""

from __future__ import annotations

import numpy as np

MIX = np.uint32(2654435761)  # Knuth's multiplicative constant
STEP = np.uint32(16777619)
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
POWERS = np.cumprod(np.r_[np.uint32(1), np.full(4095, STEP, np.uint32)], dtype=np.uint32)


def ngram_hashes(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n bytes (or characters) at each place (len - n + 1 of them)."""
    if len(data) < n:
        return np.zeros(0, np.int64)
    m = len(data) - n + 1
    h = np.full(m, np.uint32(n * int(MIX) & 0xFFFFFFFF), np.uint32)
    for k in range(n):
        h *= STEP
        h += data[k : k + m]
        h ^= h >> np.uint32(15)
    return ((h * MIX) >> np.uint32(32 - bits)).astype(np.int64)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each run of bytes for which ``inside`` holds; runs end with their document."""
    ok = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = ok.copy()
    start[1:] &= ~ok[:-1] | edge[1:-1]
    stop = ok.copy()
    stop[:-1] &= ~ok[1:] | edge[1:-1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(stop) + 1, np.searchsorted(offsets, s, "right") - 1


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each word."""
    if not len(s):
        return np.zeros(0, np.uint32)
    n = e - s
    at = np.repeat(s - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    place = at - np.repeat(s, n)
    h = np.add.reduceat((data[at].astype(np.uint32) + np.uint32(1)) * POWERS[place & 4095], np.r_[0, np.cumsum(n)[:-1]], dtype=np.uint32)
    h ^= h >> np.uint32(16)
    return h * MIX
