"""Word shingles of a text as 64-bit hashes, in NumPy: a helper for tasks, free of Spark.

A word's hash is a polynomial over its bytes modulo 2**64, taken from prefix sums of the whole text, so
cost does not depend on the number of words. Shingle hashes combine word hashes and are mixed again.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

# The white space that parts words is blank and the bytes 9 to 13.
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random value per byte, the same one for A-Z and a-z.
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[_LOWER]


class _Powers:
    """Powers of the base and of its inverse, as far as a text has needed them."""

    def __init__(self):
        self.size = 0

    def upto(self, n: int):
        if n > self.size:
            size = max(n, 2 * self.size, 1 << 16)
            self.up = self._powers(_BASE, size)
            self.down = self._powers(pow(_BASE, -1, 1 << 64), size)
            self.size = size
        return self.up, self.down

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.ones(1, dtype=np.uint64)
        while len(out) < size:
            step = np.uint64(pow(base, len(out), 1 << 64))
            out = np.concatenate([out, out * step])
        return out[:size]


_POWERS = _Powers()


def word_hashes(text: str) -> np.ndarray:
    """One hash per word, in order; A-Z and a-z are the same."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    up, down = _POWERS.upto(len(data) + 1)
    inside = ~_IS_SPACE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; a shorter text is one run of all its words.

    NULL, empty and blank texts have no shingle.
    """
    hashes = word_hashes(text) if text else np.empty(0, dtype=np.uint64)
    n = len(hashes)
    if not n:
        return hashes
    width = min(words, n)
    factors = [np.uint64(pow(_BASE, 2 * j + 3, 1 << 64)) for j in range(width)]
    total = np.full(n - width + 1, width * 0xD6E8FEB86659FD93 & _MASK, dtype=np.uint64)
    for j, factor in enumerate(factors):
        total += hashes[j : n - width + 1 + j] * factor
    return np.unique(mix(total))
