"""Words and word shingles of whole texts as 64-bit hashes (numpy).

A word is a maximal run of characters that are no white space, in lower case."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# Words are hashed all at once: sums of code points times powers of an odd number, by running
# sums over blocks of a text.  Words beyond LONG characters are hashed one by one.
LONG, _BLOCK = 4096, 1 << 16


def _powers(x: int) -> np.ndarray:
    p = np.full(_BLOCK + LONG + 1, x, np.uint64)
    p[0] = 1
    return np.cumprod(p)


_POWERS, _INVERSE = _powers(int(_MULT)), _powers(pow(int(_MULT), -1, 1 << 64))
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])         # no white space after U+3000


def words(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word, in order."""
    if not text:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    space = np.ones(len(codes) + 2, bool)
    space[1:-1] = _SPACE.take(codes, mode="clip")
    edges = np.flatnonzero(space[1:] != space[:-1])
    start, stop = edges[::2], edges[1::2]
    size = stop - start
    end = start + np.minimum(size, LONG)
    out = np.empty(len(start), np.uint64)
    cuts = np.unique(np.searchsorted(start, np.arange(0, len(codes) + _BLOCK, _BLOCK)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, hi = start[a], end[b - 1]
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(codes[lo:hi] * _POWERS[:hi - lo], out=sums[1:])
        out[a:b] = (sums[end[a:b] - lo] - sums[start[a:b] - lo]) * _INVERSE[start[a:b] - lo]
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh64_intdigest(codes[start[i]:stop[i]].tobytes())
    return mix(out + size.astype(np.uint64) * _MULT)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingles(h: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of every run of ``k`` words; a shorter text is one shingle, none without words."""
    n = len(h)
    if n == 0:
        return h
    k = min(k, n)
    s = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        s = s * _MULT + h[i:n - k + 1 + i]
    return mix(s)
