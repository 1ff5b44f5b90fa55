"""Word shingles of whole texts as 64-bit numbers, computed for a block of texts at a time with numpy.

A word is a run of bytes other than space and 0x09-0x0D in the UTF-8 text, with A-Z lower-cased. A shingle is `width`
words in a row; a text with fewer words has one shingle made of all its words, a text without words has none.
"""

from __future__ import annotations

import numpy as np

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    start = np.uint64(salt & _MASK)
    return mixed(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_STEP))


_BYTE = seeds(256, 11)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = both
    return _powers[0], _powers[1]


def words(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word in a block of text."""
    raw = np.frombuffer(block, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    gap = np.empty(len(raw) + 2, dtype=bool)
    gap[0] = gap[-1] = True
    np.take(_SPACE, raw, out=gap[1:-1])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edges[::2], edges[1::2]
    up, down = _tables(len(raw))
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    return start, mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    block = b"\n".join(texts)
    starts, hashes = words(block)
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.empty(0, np.int64)
    cuts = np.concatenate([[0], np.searchsorted(starts, ends)])
    factors = seeds(width, 23) | np.uint64(1)
    rolled = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for k in range(width):
        rolled += hashes[k : k + len(rolled)] * factors[k]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= width:
            part = np.sort(rolled[a : b - width + 1])
            keep = np.empty(len(part), dtype=bool)
            keep[0] = True
            np.not_equal(part[1:], part[:-1], out=keep[1:])
            out.append(part[keep])
        elif b > a:
            whole = (hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64)
            out.append(mixed(np.array([int(whole) + (b - a) * _STEP & _MASK], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
