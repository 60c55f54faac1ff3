"""Anchors: places that equal stretches of text agree on.

Of every window of ``length`` bytes the anchor is the start of the run of ``gram`` bytes with
the smallest hash in it, the first of equals. Equal windows have equal anchors at equal
offsets, wherever they are. Windows in a row with one anchor make a segment.
"""

from __future__ import annotations

import numpy as np

GRAM = 32
_PLACE_BITS = 22
#: Window starts looked at together; bounds memory only. Longer texts are cut into such parts.
PART = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTERS = np.random.Generator(np.random.PCG64(1)).integers(0, 1 << 63, 256, np.uint64)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.empty(count, np.uint64)
    out[0] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < count:
            step = min(done, count - done)
            out[done : done + step] = out[:step] * (out[done - 1] * base)
            done += step
    return out


_UP = _powers(_ODD, PART + 1024)
_DOWN = _powers(_INVERSE, PART + 1024)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place."""
    with np.errstate(over="ignore"):
        sums = np.empty(len(raw) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_LETTERS[raw] * _DOWN[: len(raw)], out=sums[1:])
        return _mix((sums[gram:] - sums[:-gram]) * _UP[: len(raw) - gram + 1])


def segments(raw: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window start and number of windows of each segment of ``raw``,
    which holds at most ``PART + length - 1`` bytes."""
    windows = len(raw) - length + 1
    if windows <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = gram_hashes(raw, gram)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    best = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span = length - gram + 1
    width = 1
    while width < span:
        step = min(width, span - width)
        best = np.minimum(best[:-step], best[step:])
        width += step
    place = (best & low).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    count = np.diff(np.append(first, windows))
    return hashes[place[first]].view(np.int64), first, count
