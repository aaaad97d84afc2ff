"""Rabin-Karp hashes of word windows, modulo 2^64 and twice over, without loops over words."""

from __future__ import annotations

import numpy as np
import xxhash

#: Bases of the two polynomials: odd, so that they have inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Distinct words whose hashes a task remembers, and the longest word remembered.
REMEMBERED, LONGEST = 500_000, 64


class WordHashes(dict):
    """The two 64-bit halves of a word's XXH3 hash as 16 bytes, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> bytes:
        made = xxhash.xxh3_128_digest(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = made
        return made

    def of(self, words: list[bytes]) -> np.ndarray:
        """One row of two hashes per word."""
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u8").reshape(-1, 2)


class Powers:
    """Powers of a base and of its inverse, grown to the longest text seen."""

    def __init__(self, base: int):
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]))
                                  for b in (self.base, self.back))
        return self.up[:n], self.down[:n]


_POWERS = tuple(Powers(b) for b in BASES)


def mixed(numbers: np.ndarray) -> np.ndarray:
    """Hashes of 64-bit numbers, one for one."""
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return numbers ^ (numbers >> np.uint64(32))


def windows(hashes: np.ndarray, size: int, half: int = 0) -> np.ndarray:
    """Hash of each window of ``size`` words, from one half of the words' hashes."""
    n = len(hashes)
    if n < size:
        return np.empty(0, np.uint64)
    up, down = _POWERS[half].upto(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes[:, half] * up, out=sums[1:])
    return (sums[size:] - sums[:-size]) * down[:n - size + 1]


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Least value of each run of ``size`` values."""
    width, low = 1, values
    while 2 * width <= size:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:len(values) - size + 1], low[size - width:size - width + len(values) - size + 1])
