"""Word and shingle hashes of whole texts, vectorised over words."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
SEED = 0x5EED


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int = int(_BASE)):
        self.base, self.inverse = _U(base), _U(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = np.cumprod(np.concatenate([[_U(1)], np.full(size, self.base)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[_U(1)], np.full(size, self.inverse)]), dtype=np.uint64)
        return self.up[:n], self.down[:n]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word (A-Z lower-cased, cut at ASCII white space); each distinct word is hashed once."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    known = {w: xxhash.xxh3_64_intdigest(w, SEED) for w in dict.fromkeys(words)}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle."""
    words = word_hashes(text or "")
    n = len(words)
    if n == 0:
        return words
    k = min(n, size)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = mix64(h * _BASE + words[i : n - k + 1 + i])
    return np.unique(h)


def set_id(members: np.ndarray) -> int:
    """Signed 64-bit fingerprint of a sorted set."""
    return int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)
