"""Vectorised words, word hashes and shingle hashes over UTF-8 buffers."""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(pow(int(_P), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads each bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _P)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n + 1:
        size = max(n + 1, PIECE + 1)
        up, down = np.full(size, _P), np.full(size, _Q)
        up[0] = down[0] = 1
        made = np.cumprod(up), np.cumprod(down)
        if size > 4 * PIECE:  # for one giant word; not kept
            return made
        _powers = made
    return _powers


def _piece(data: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of one piece; bounds: where rows begin."""
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner] = solid[inner]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64)), starts, ends


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the rows in order, and each row's first word (one more than rows).

    Memory is some twenty times PIECE besides eight bytes a word, also for a row of any length: a long row is
    cut at blanks. Only one word longer than PIECE takes memory in proportion to itself.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    found, firsts, a = [], [], lo
    while a < hi:
        b = min(hi, a + PIECE)
        if b < hi and not _BLANK[data[b]] and b not in offsets:
            back = np.flatnonzero(_BLANK[data[a:b]])
            if len(back):
                b = a + int(back[-1]) + 1
            else:
                step = b
                while step < hi:
                    blank = np.flatnonzero(_BLANK[data[step : step + PIECE]])
                    if len(blank):
                        break
                    step += PIECE
                b = min(hi, step + int(blank[0])) if step < hi else hi
        inside = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a
        h, s, _ = _piece(data[a:b], inside, lower)
        found.append(h)
        firsts.append(s + a)
        a = b
    h = np.concatenate(found) if found else np.zeros(0, np.uint64)
    s = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    return h, np.searchsorted(s, offsets)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each run of n words; position i is the run that starts there."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out = (out * _P) + h[j : len(h) - n + 1 + j]
    return mix(out)


def shingle_set(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one row's words; with fewer words the whole sequence is one shingle."""
    if not len(h):
        return np.zeros(0, np.uint64)
    if len(h) < n:
        out = np.full(1, len(h), np.uint64)
        for x in h:
            out = out * _P + x
        return mix(out ^ np.uint64(0x5851F42D4C957F2D))
    out = grams(h, n)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]
