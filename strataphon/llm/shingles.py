"""Hashed word shingles of whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import held

CACHE_WORDS = 300_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class Shingler:
    """Sorted distinct hashes of a text's ``width``-word shingles.

    A-Z are lower-cased; words are runs of bytes other than blank and \\t to \\r. A text of fewer words is one
    shingle, its whole word sequence; without words there is none.
    """

    def __init__(self, width: int):
        self.width, self.words = width, held("shingles", WordHashes)

    def __call__(self, text: np.ndarray) -> np.ndarray:
        """``text`` as its UTF-8 bytes."""
        words = text.tobytes().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        ids = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(ids))
        out = np.full(len(ids) - width + 1, width, np.uint64) * _STEP
        for k in range(width):
            out = mix(out + ids[k : len(ids) - width + 1 + k])
        return np.unique(out)
