"""Word shingles of whole texts as sorted 64-bit numbers, and the segment
signatures of such sets."""

from __future__ import annotations

import numpy as np
import xxhash

from panelspark.llm.common import WS_BYTES

WIDTH = 5
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Word → 64-bit hash, remembering a bounded number of words."""

    def __init__(self, seed: int = 0, most: int = 300_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h


def shingle_set(text: bytes | None, words: Words) -> np.ndarray:
    """Sorted distinct hashes of the text's five-word shingles; of all its
    words as one where there are fewer; empty without words."""
    found = (text or b"").translate(LOWER).split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, n)
    wide = min(n, WIDTH)
    s = np.full(n - wide + 1, wide, np.uint64)
    for k in range(wide):
        s = mixed(s * _ODD + h[k:n - wide + 1 + k])
    return np.unique(s)


assert sorted(WS_BYTES) == sorted(c for c in range(128) if not bytes([c]).split())
