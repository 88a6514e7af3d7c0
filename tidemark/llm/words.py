"""Words, word hashes and word shingles of whole texts, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd 64-bit multipliers: fixed values, from the fractional parts of well-known constants.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD,
                0xC4CEB9FE1A85EC53, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


class WordHashes(dict):
    """64-bit hash of a word, kept for the words seen lately (a cache of bounded size)."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    h = h ^ (h >> np.uint64(31))
    h = h * MIX[6]
    h = h ^ (h >> np.uint64(29))
    h = h * MIX[7]
    return h ^ (h >> np.uint64(32))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words, in order of place."""
    count = len(hashes) - n + 1
    out = hashes[:count] * MIX[0]
    for j in range(1, n):
        # Rotating between the steps makes the order of the words count.
        out = ((out << np.uint64(17)) | (out >> np.uint64(47))) * MIX[1] + hashes[j:j + count] * MIX[0]
    return mixed(out)


def shingles(hashes: np.ndarray, n: int = 5) -> np.ndarray:
    """Distinct ``n``-word shingles, sorted; a shorter text is one shingle, an empty one has none."""
    if len(hashes) == 0:
        return np.empty(0, dtype=np.uint64)
    return np.unique(grams(hashes, n)) if len(hashes) >= n else grams(hashes, len(hashes)) ^ np.uint64(len(hashes))


def lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case (bytes.split and lower know ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []

