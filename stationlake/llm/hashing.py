"""64-bit hashes of words and of runs of words, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hash a task keeps at hand: 500,000 took about 80 MB, and hashing a word again is cheap.
KEPT_WORDS = 100_000
BASE = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """The hash of a word, looked up like a dict; a bounded number is remembered."""

    def __init__(self, kept: int = KEPT_WORDS) -> None:
        self.kept = kept

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.kept:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def rabin_karp(values: np.ndarray, size: int) -> np.ndarray:
    """The polynomial hash (modulo 2**64) of every run of ``size`` values, by Horner's rule over shifted
    views; fewer values than that have no run."""
    runs = len(values) - size + 1
    if runs <= 0:
        return np.empty(0, dtype=np.uint64)
    h = values[:runs].copy()
    for j in range(1, size):
        h *= BASE
        h += values[j : j + runs]
    return mixed(h)
