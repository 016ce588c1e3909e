"""Vectorised text kernels over UTF-8 bytes: word bounds, word hashes, k-gram hashes.

A hash is the polynomial sum of random 64-bit byte codes modulo 2**64, so hashes of all words come from
one running sum over the buffer; a final mix spreads the bits.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_Q = np.uint64(0xD1342543DE82EF95)
_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[0:0x30] = NOT_ALNUM[0x3A:0x61] = NOT_ALNUM[0x7B:0x80] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        n = max(n, 1 << 16)
        for k, base in enumerate((_P, _PINV)):
            seq = np.full(n, base, np.uint64)
            seq[0] = 1
            _POW[k] = np.cumprod(seq)
    return _POW[0], _POW[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spans:
    """Hashes of spans of one sequence: of bytes, or of words given by their 64-bit hashes."""

    def __init__(self, items: np.ndarray):
        n = len(items)
        up, self.down = _powers(n + 1)
        self.run = np.zeros(n + 1, np.uint64)
        np.cumsum((_CODES[items] if items.dtype == np.uint8 else items) * up[:n], out=self.run[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed 64-bit hashes of the spans [start, end)."""
        return mix((self.run[ends] - self.run[starts]) * self.down[starts])


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Spans(buf)(starts, ends)


def word_bounds(buf: np.ndarray, offsets: np.ndarray, delim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the number of words of each row."""
    n = len(buf)
    inside = ~delim[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def words(buf: np.ndarray, offsets: np.ndarray, delim: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) of all rows, and the number of words of each row."""
    low = LOWER[buf]
    starts, ends, counts = word_bounds(low, offsets, delim)
    return span_hashes(low, starts, ends), counts


def grams(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the k-grams of each row, their first word's index in ``h``, and their number by row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(counts), np.int64)
    acc = h[:n].copy()
    for j in range(1, k):
        acc = acc * _Q + h[j:j + n]
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(row[:n] == row[k - 1:])
    return mix(acc[at] + np.uint64(k)), at, np.maximum(counts - k + 1, 0)
