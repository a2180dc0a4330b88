"""Words of texts as 64-bit names, computed on whole buffers of UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from .common import GOLD, mix64

#: Bytes handled at a time; a buffer is cut between words.
PIECE = 1 << 18
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: One odd-looking 64-bit value per byte.
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * GOLD)
_BASE = 0xD6E8FEB86659FD93
_powers: dict[str, np.ndarray] = {}


def _power(n: int, inverse: bool = False) -> np.ndarray:
    key = "inverse" if inverse else "base"
    if key not in _powers or len(_powers[key]) < n:
        b = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        steps = np.full(max(n, PIECE + 1), b, dtype=np.uint64)
        steps[0] = 1
        _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers[key]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than blank, tab, line feed, VT, FF and CR."""
    word = np.zeros(len(data) + 2, bool)
    np.logical_not(_BLANK[data], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[::2], edge[1::2]


def _name(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of the words by content: a polynomial over the bytes by prefix sums, mixed."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power(len(data))[:len(data)], dtype=np.uint64, out=sums[1:])
    h = (sums[end] - sums[start]) * _power(len(data), True)[start]
    return mix64(h + (end - start).astype(np.uint64) * GOLD)


def word_names(texts: list[bytes], lower: bool = False) -> list[np.ndarray]:
    """The names of each text's words in order. ``lower``: A-Z count as a-z."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush():
        data = np.frombuffer(b" ".join(held) + b" ", dtype=np.uint8)
        if lower:
            data = _LOWER[data]
        start, end = word_bounds(data)
        names = _name(data, start, end)
        first = np.searchsorted(start, np.cumsum([0] + [len(h) + 1 for h in held]))
        out.extend(names[a:z] for a, z in zip(first[:-1], first[1:]))

    for t in texts:
        if len(t) > PIECE:
            if held:
                flush()
                held, size = [], 0
            out.append(_long(t, lower))
            continue
        held.append(t)
        size += len(t) + 1
        if size >= PIECE:
            flush()
            held, size = [], 0
    if held:
        flush()
    return out


def _long(t: bytes, lower: bool) -> np.ndarray:
    """A long text in pieces that end at a blank."""
    data = np.frombuffer(t, dtype=np.uint8)
    blanks = np.flatnonzero(_BLANK[data])
    got, at = [np.zeros(0, np.uint64)], 0
    while at < len(data):
        i = np.searchsorted(blanks, at + PIECE)
        cut = int(blanks[i]) if i < len(blanks) else len(data)
        part = _LOWER[data[at:cut]] if lower else data[at:cut]
        got.append(_name(part, *word_bounds(part)))
        at = cut + 1
    return np.concatenate(got)


def sequence_names(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit names of every ``n`` consecutive names."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    m = len(h) - n + 1
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += h[i:i + m]
    return mix64(out)
