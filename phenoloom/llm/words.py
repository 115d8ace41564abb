"""Words as hashes inside tasks. A word is a run of ``[^\\x20\\x09-\\x0D]``, which is what ``bytes.split()`` yields."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import xxhash

#: Words that a Python worker remembers at once. The memory forgets all when full; values never depend on it.
REMEMBERED = 150_000
_BASE, _BASE2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class WordHashes(dict):
    """Word bytes to a 64-bit hash, computed once for each remembered word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words)).view(np.uint64)


#: One memory for all operators: a worker lives through many tasks of many stages.
REMEMBERED_WORDS = WordHashes()


def release() -> None:
    """After a task: give back what the worker holds, as the next task may be another operator's."""
    REMEMBERED_WORDS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps what was freed otherwise
        trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Windows:
    """Rabin-Karp hashes modulo 2**64 of every run of ``width`` values, from prefix sums over inverse powers."""

    def __init__(self, width: int, base: int = _BASE):
        self.width, self.base = width, base
        self.inverse = np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = np.full(n, np.uint64(self.base)), np.full(n, self.inverse)
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)

    def of(self, values: np.ndarray) -> np.ndarray:
        """One hash per start; empty if there are fewer than ``width`` values."""
        n = len(values) - self.width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        self._powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.down[: len(values)], out=sums[1:])
        return (sums[self.width :] - sums[:n]) * self.up[:n]


def two_windows(width: int) -> tuple[Windows, Windows]:
    """Two independent families: one to compare windows by, one to deal them out by."""
    return Windows(width), Windows(width, _BASE2)


def inside(lengths: np.ndarray, width: int) -> np.ndarray:
    """Among the window starts over texts laid end to end, those whose window stays in its text."""
    total = int(lengths.sum())
    n = max(0, total - width + 1)
    left = np.repeat(np.cumsum(lengths), lengths)[:n] - np.arange(n)
    return left >= width


def covered(starts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Mask of the ``n`` words that a window beginning at one of ``starts`` covers."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, n), -1)
    return np.cumsum(edges[:-1]) > 0
