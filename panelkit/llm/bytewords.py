"""Words of a text as 64-bit hashes, from whole arrays of bytes.

A word's hash is a polynomial in the bytes' random images, taken as a difference
of running sums and divided by the power of its place; arithmetic is modulo 2^64,
where odd numbers have inverses. Equal words have equal hashes everywhere.
"""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
# Bytes hashed at once; only words longer than this take several steps.
STEP = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, first: int = 0) -> np.ndarray:
    """``n`` fixed random 64-bit numbers."""
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(first)) * np.uint64(BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class ByteWords:
    """Finds and hashes the maximal runs of word bytes."""

    def __init__(self, separators: bytes) -> None:
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        self.image = seeds(256)
        self._up = self._down = np.empty(0, np.uint64)

    def _tables(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = 1 << max(12, (n - 1).bit_length())
            self._up, self._down = _powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size)
        return self._up, self._down

    def _hash(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self._tables(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.image[data] * up[:len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, starts and ends of the words in an array of bytes."""
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = self.is_word[data]
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        if len(data) <= STEP:
            return self._hash(data, starts, ends), starts, ends
        hashes, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + STEP, "right")))
            first = starts[at]
            hashes[at:stop] = self._hash(data[first:ends[stop - 1]], starts[at:stop] - first, ends[at:stop] - first)
            at = stop
        return hashes, starts, ends
