"""Vectorised Rabin-Karp hashing of words and word windows (numpy, inside tasks).

A polynomial hash modulo 2**64 of any slice is a difference of prefix sums times a power of the inverse base,
so all words, and all windows of words, of a block are hashed by a few array operations.
"""

from __future__ import annotations

import numpy as np

#: Odd bases (hence invertible modulo 2**64): one for bytes, two independent ones for words.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)

#: Bytes hashed at a time.
BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def slices(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial hash of ``values[start:end]`` for each pair."""
    n = len(values)
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(base, n)[:-1], out=sums[1:])
    return (sums[end] - sums[start]) * _powers(inverse, n)[start]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word ``[^\\x20\\x09-\\x0D]+`` of all texts in order, words per text)."""
    joined = b" ".join(texts)
    data = np.frombuffer(joined, np.uint8)
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    hashes, at, where = [], 0, []
    while at < len(data):
        stop = min(at + BLOCK, len(data))
        while stop < len(data) and not _SPACE[data[stop]]:  # a block ends between words
            more = np.flatnonzero(_SPACE[data[stop:stop + BLOCK]])
            stop = stop + int(more[0]) if len(more) else min(stop + BLOCK, len(data))
        part = data[at:stop]
        inside = np.concatenate(([0], (~_SPACE[part]).view(np.int8), [0]))
        step = np.diff(inside)
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        if len(start):
            poly = slices(part.astype(np.uint64) + np.uint64(1), BYTE_BASE, start, end)
            hashes.append(mix(poly + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
            where.append(start + at)
        at = stop
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    where = np.concatenate(where)
    return np.concatenate(hashes), np.diff(np.searchsorted(where, begins))


def window_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first 64 bits, 16 further bits, first word) of every window of ``width`` words inside one text."""
    text = np.repeat(np.arange(len(counts)), counts)
    n = max(0, len(words) - width + 1)
    at = np.flatnonzero(text[:n] == text[width - 1:width - 1 + n])
    first = mix(slices(words, WORD_BASES[0], at, at + width))
    second = (mix(slices(words, WORD_BASES[1], at, at + width)) >> np.uint64(48)).astype(np.uint16)
    return first, second, at
