"""64-bit hashes of a text's words, for all words at once.

A word's hash is a polynomial in its bytes modulo 2**64, taken from prefix sums
over the text and mixed with the word's length; very long words are hashed on
their own.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Words are what stands between these bytes (ASCII white space).
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes whose prefix sums are held at once; longer words are hashed on their own.
SPAN, LONG = 1 << 20, 1 << 16

MIX, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
_BASE = 0xD1342543DE82EF95  # odd, so that it has an inverse
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each."""
    if len(_powers[0]) < size:
        size = max(size, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> SHIFT)) * MIX
    return value ^ (value >> np.uint64(32))


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    power, inverse = _tables(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    return mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * MIX)


def word_hashes(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte end) of every word; null has none."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(text, np.uint8)
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[::2], edge[1::2]
    if len(data) <= LONG:
        return _hashed(data, start, end), start, end
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + SPAN, "right")))
        long = np.flatnonzero(end[at:stop] - start[at:stop] > LONG)
        if len(long) and long[0] == 0:
            out[at] = xxhash.xxh3_64_intdigest(text[start[at]:end[at]])
            at += 1
            continue
        stop = at + int(long[0]) if len(long) else stop
        first = start[at]
        out[at:stop] = _hashed(data[first:end[stop - 1]], start[at:stop] - first, end[at:stop] - first)
        at = stop
    return out, start, end


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    last = len(hashes) - size + 1
    value = hashes[:last] ^ np.uint64(size)
    for k in range(1, size):
        value = (value ^ (value >> SHIFT)) * MIX + hashes[k:last + k]
    return mixed(value)
