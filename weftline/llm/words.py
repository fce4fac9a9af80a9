"""Vectorised hashes of words and word n-grams of many texts at once."""

from __future__ import annotations

import re

import numpy as np

#: ASCII and general punctuation, and a few marks of Latin-1.
_MARKS = re.compile("[!-/:-@\\[-`{-~\u00a0-\u00bf\u2010-\u2027\u2030-\u205e\u3000-\u3002]+")

_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i under n at least."""
    if base not in _CACHE or len(_CACHE[base][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(size, b, dtype=np.uint64)
            a[0] = 1
            both.append(np.cumprod(a, dtype=np.uint64))
        _CACHE[base] = (both[0], both[1])
    return _CACHE[base]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, dtype=np.uint64, out=out[1:])
    return out


def word_hashes(texts: list[str], base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII whitespace), and where each text's words begin: text i has words first[i]:first[i + 1]. Another odd base gives other hashes."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]), dtype=np.uint8)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    up, down = powers(base, len(data) + 1)
    total = sums((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])
    hashes = mix((total[end] - total[begin]) * down[begin])
    at = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return hashes, np.searchsorted(begin, at)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k consecutive words from each word on; as many as there are whole k-grams."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    up, down = powers(_STEP, len(words) + 1)
    total = sums(words * up[: len(words)])
    return mix((total[k:] - total[:n]) * down[:n] + np.uint64(k))


def normal(text: str) -> str:
    """In lower case, with punctuation as space."""
    return _MARKS.sub(" ", text.lower())
