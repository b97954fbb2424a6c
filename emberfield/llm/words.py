"""Words, word hashes and rolling window hashes used inside tasks.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return; ``bytes.split`` cuts at exactly these. Hashes are 64
bits wide and depend on content alone, so every task and every retry agrees.
"""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class WordHashes(dict):
    """Hash of each word seen so far; emptied when it outgrows ``limit``."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of a whole text; ``lower`` lower-cases A-Z first. Null has none."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.translate(_LOWER) if lower else data).split()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled : filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
        filled += step
    return out


class Windows:
    """Rabin-Karp hashes of all windows of ``size`` words, modulo 2**64.

    The hash of words i..i+size-1 is the sum of word[i+j] * base**(size-1-j),
    taken from one running sum, so the cost does not depend on the size.
    """

    def __init__(self, size: int):
        self.size = size
        self._up = self._down = np.ones(1, np.uint64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        n, k = len(hashes), self.size
        if n < k:
            return hashes[:0]
        if len(self._up) < n + 1:
            self._up, self._down = _powers(_BASE, 2 * n + 1), _powers(_BASE_INVERSE, 2 * n + 1)
        running = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self._down[:n], out=running[1:])
        return (running[k:] - running[:-k]) * self._up[k - 1 : n]
