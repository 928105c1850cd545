"""Word shingles of whole texts as 64-bit hashes, and MinHash sketches, in numpy.

Words are runs of anything but ASCII white space, with A-Z in lower case. A word's hash is a
polynomial over its bytes (random 64-bit values for the bytes, an odd base, modulo 2^64) taken
from one running sum over the text; a shingle's hash mixes those of its words in order.
"""

from __future__ import annotations

import numpy as np

_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as far as texts need them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up), 1 << 16)
            self.up = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, _BASE))))
            self.down = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, _BACK))))
        return self.up, self.down


_powers = _Powers()


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word of the text, in order."""
    b = np.frombuffer(text.encode().translate(_LOWER), np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    word = ~_SPACE[b]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    edge = np.concatenate(([0] * int(word[0]), edge, [len(b)] * int(word[-1]))).astype(np.int64)
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(b) + 1)
    run = np.empty(len(b) + 1, np.uint64)
    run[0] = 0
    np.cumsum(_BYTE[b] * up[:len(b)], out=run[1:])
    return mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """The text's distinct k-word shingles, sorted; a text of fewer words is one shingle."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    k = min(k, len(w))
    s = w[:len(w) - k + 1]
    for j in range(1, k):
        s = mix(s * _M2 + w[j:len(w) - k + 1 + j])
    return np.unique(s)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    return int(mix(s + _M1).sum().astype(np.int64)), int(mix(s ^ _M2).sum().astype(np.int64))


class Sketcher:
    """MinHash sketches: 16 bits of each of `size` minima."""

    def __init__(self, size: int = 256, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(1, 1 << 32, size, dtype=np.uint32) | np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, size, dtype=np.uint32)[:, None]

    def __call__(self, s: np.ndarray) -> np.ndarray:
        x = (s >> np.uint64(17)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 2048):
            np.minimum(low, (self.a * x[i:i + 2048] + self.b).min(axis=1), out=low)
        return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
