"""Hashed word shingles of whole texts, for tasks that work on Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash per word, remembered; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a text with A-Z lower-cased; the whole
    sequence as one shingle if it has fewer words; nothing without words. ``bytes.split`` cuts at exactly
    space, tab, line feed, vertical tab, form feed and carriage return."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    word = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    size = min(SHINGLE, len(word))
    count = len(word) - size + 1
    total = np.full(count, np.uint64(size))
    for k in range(size):
        total = mixed(total * _ODD[k] + word[k : k + count])
    return np.unique(total)
