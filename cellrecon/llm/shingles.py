"""Word shingles as 64-bit hashes, and minima of them under seeded orders."""

from __future__ import annotations

import numpy as np
import xxhash

from cellrecon.llm import memos

#: A worker remembers the hashes of so many words.
REMEMBERED = 150_000
WIDTH = 5

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed image of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """Distinct shingles of the lower-cased words, ascending. Fewer words than ``width`` make one shingle, none none."""
    words = text.lower().encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = memos.held("word hashes", _Hashes)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - width + 1, 1)
    found = np.zeros(n, np.uint64)
    for k in range(min(width, len(words))):
        found = found * _PRIME + hashes[k : k + n]
    return np.unique(mixed(found))


def minima(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each seed the least shingle in the order the seed gives, as its mixed value."""
    return np.array([mixed(shingles ^ s).min() for s in seeds], np.uint64)


def seeds(n: int, first: int = 1) -> np.ndarray:
    return mixed((np.arange(first, first + n, dtype=np.uint64)) * _PRIME)
