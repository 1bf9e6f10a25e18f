"""Sets of word shingles as sorted 64-bit hashes, computed on whole arrays of bytes.

Words are runs of anything but blanks (space, tab to carriage return), A-Z in lower case; a shingle is ``width``
neighbouring words, and a shorter text is one shingle of all its words. Two different shingles share a hash with a
chance of 2^-64.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_powers = [np.ones(1, U), np.ones(1, U)]


def _power(which: int, size: int) -> np.ndarray:
    """BASE^0, BASE^1, ... modulo 2^64, or those of its inverse."""
    if len(_powers[which]) < size:
        step = np.full(max(size, 1 << 15), BASE if which == 0 else pow(BASE, -1, 1 << 64), U)
        step[0] = 1
        _powers[which] = np.multiply.accumulate(step)
    return _powers[which][:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all others."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of every word of UTF-8 text, in order."""
    raw = np.frombuffer(data, np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, U)
    lower = raw.astype(U) + U(32) * ((raw >= 65) & (raw <= 90)) + U(1)
    sums = np.concatenate((np.zeros(1, U), np.cumsum(lower * _power(0, len(raw)), dtype=U)))
    return mix((sums[ends] - sums[starts]) * _power(1, len(raw) + 1)[starts] + (ends - starts).astype(U))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; none for a text without words."""
    words = word_hashes((text or "").encode())
    size = min(width, len(words))
    if not size:
        return words
    out = np.full(len(words) - size + 1, U(size * BASE % (1 << 64)), U)
    for k in range(size):
        out += words[k : len(words) - size + 1 + k] * U(pow(BASE, 2 * k + 3, 1 << 64))
    return np.unique(mix(out))


def set_id(hashes: np.ndarray) -> int:
    """A signed 64-bit number for a set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1) if len(b) else np.zeros(0, int)
    return int((b[at] == a).sum()) if len(b) else 0
