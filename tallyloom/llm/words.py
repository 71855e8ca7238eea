"""Words of texts as 64-bit hashes, and Karp-Rabin hashes of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words of up to 64 characters that a worker remembers: some 30 MB.
_MOST = 100_000
_LONGEST = 64
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word) -> int:
        if len(self) >= _MOST:
            self.clear()
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= _LONGEST:
            self[word] = found
        return found


_hashes = _Hashes()


def forget() -> None:
    """Free what a worker remembers of words: workers outlive their operators."""
    _hashes.clear()


def hashed(words: list) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of each run of ``size`` words; none if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = hashes[:n].copy()
    for k in range(1, size):
        total *= _BASE
        total += hashes[k : n + k]
    return total
