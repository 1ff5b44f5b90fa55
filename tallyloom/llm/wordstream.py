"""Hashes of all words of whole texts, in blocks of bounded size however long a text is."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from tallyloom.llm.shingles import mixed, seeds

#: Bytes whose words are hashed at a time.
BLOCK = 1 << 20

_BYTE = seeds(256, 31)
_BASE = 0x27BB2EE687B0B0FD  # odd, so it has an inverse modulo 2**64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_GAP = re.compile(rb"[\x20\t-\r]")
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse below n; n is bounded by the callers' blocks."""
    if not _powers or len(_powers[0]) < n:
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = both
    return _powers[0][:n], _powers[1][:n]


def sums(values: np.ndarray) -> np.ndarray:
    """Running sums of values times powers of the base, from 0."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def spans(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One number for the values of each span, wherever it stands; `running` comes from `sums`."""
    down = powers(len(running))[1]
    return mixed((running[end] - running[start]) * down[start] + (end - start).astype(np.uint64))


def words(block: bytes, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of the words of a block, which are the runs of bytes that are no gaps."""
    raw = np.frombuffer(block, dtype=np.uint8)
    gap = np.ones(len(raw) + 2, dtype=bool)
    np.take(gaps, raw, out=gap[1:-1])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edges[::2], edges[1::2]
    return start, end, spans(sums(_BYTE[raw]), start, end)


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(number of the text, piece): texts cut at white space after each block's worth of bytes."""
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > BLOCK:
            gap = _GAP.search(text, at + BLOCK)
            end = gap.start() if gap else len(text)
            yield i, text[at:end]
            at = end
        yield i, text[at:] if at else text


def hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, in order; where each text's words begin, and the end)."""
    counts = np.zeros(len(texts), dtype=np.int64)
    found: list[np.ndarray] = []
    owners: list[int] = []
    block: list[bytes] = []
    size = 0

    def flush() -> None:
        if not block:
            return
        start, _, own = words(b"\n".join(block))
        ends = np.cumsum([len(p) + 1 for p in block])
        per = np.diff(np.searchsorted(start, ends), prepend=0)
        np.add.at(counts, owners, per)
        found.append(own)
        block.clear()
        owners.clear()

    for i, piece in _pieces(texts):
        if size + len(piece) > 2 * BLOCK:
            flush()
            size = 0
        block.append(piece)
        owners.append(i)
        size += len(piece) + 1
    flush()
    own = np.concatenate(found) if found else np.empty(0, dtype=np.uint64)
    return own, np.concatenate([[0], np.cumsum(counts)])
