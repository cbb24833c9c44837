"""Words of texts as arrays of 64-bit hashes, for whole Arrow batches at once."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile("[a-z0-9]+")
_CACHE_WORDS = 1_000_000


def words(text: str | None) -> list[str]:
    """The maximal runs of a-z0-9 in the lower-cased text; null and blank give none."""
    return WORD.findall(text.lower()) if isinstance(text, str) else []


class Hashes(dict):
    """Word to hash; forgets everything when it has grown too large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A full-avalanche permutation of 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h + np.uint64(0x9E3779B97F4A7C15 + salt)).astype(np.uint64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` values; one entry per start, none where the run would pass the end."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            h = mix(h ^ ids[j : j + n], j)
    return h
