"""Words of many texts as 64-bit hashes, computed on whole byte buffers.

A word is a longest run without ``[\\x20\\x09-\\x0D]``. Its hash is the sum of
a fixed random value per byte times a power of an odd constant (mod 2**64),
followed by a bijective mix; equal words have equal hashes in every process.
"""

from __future__ import annotations

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(20240313)).integers(1, 1 << 63, 256, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data - np.uint8(9)) < np.uint8(5))


_kept: dict[int, np.ndarray] = {}


def _powers(n: int, base: int = _ODD) -> np.ndarray:
    """The powers 0 to ``n`` of ``base``; those up to a block's length are kept."""
    out = _kept.get(base)
    if out is None or len(out) <= n:
        out = np.full(max(n, _BLOCK) + 1, np.uint64(base))
        out[0] = 1
        out = np.cumprod(out, dtype=np.uint64)
        if n <= 2 * _BLOCK:
            _kept[base] = out
    return out[:n + 1]


def _word_sums(data: np.ndarray, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[data[start + j]] * odd**j`` over each [start, end), in blocks of words."""
    out = np.empty(len(starts), np.uint64)
    inverse = pow(_ODD, -1, 1 << 64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, side="right")))
        lo, hi = int(starts[at]), int(ends[to - 1])
        powers = _powers(hi - lo)
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data[lo:hi]] * powers[:-1], dtype=np.uint64, out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = (sums[e] - sums[s]) * _powers(hi - lo, inverse)[s]
        at = to
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and each text's offsets among them.

    ``data`` holds the texts one after another, ``offsets`` where each starts.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~is_space(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[1:-1]
    edge = edge[edge < len(data)]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = mix(_word_sums(data, _byte_values(lower), starts, ends)
                 + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def windows(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word windows within the texts, and the position of each
    window's first word. Windows never cross from one text into the next."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = hashes[:count].copy()
    for k in range(1, n):
        acc = acc * np.uint64(_ODD) + hashes[k:k + count]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(doc[:count] == doc[n - 1:n - 1 + count])
    return mix(acc[at]), at
