"""Word shingles of texts as sorted arrays of 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SLAB = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    return lower, white


_LOWER, _WHITE = _tables()
_CODES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MULTIPLIER)[_LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], known = 1, 1
    while known < n:
        step = np.uint64(pow(base, known, 2**64))
        take = min(known, n - known)
        out[known:known + take] = out[:take] * step
        known += take
    return out


_BASE = 0xD1342543DE82EF95
_UP = _powers(_BASE, _SLAB + 1)
_DOWN = _powers(pow(_BASE, -1, 2**64), _SLAB + 1)


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of a byte array, with A-Z lower-cased."""
    solid = ~_WHITE[raw]
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    found = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, first + _SLAB, side="right")))
        if ends[to - 1] - first > _SLAB:  # a word longer than a slab
            part = _CODES[raw[first:ends[at]]]
            h = 0
            for i in range(0, len(part), _SLAB):
                piece = part[i:i + _SLAB]
                h = (h * _BASE + int((piece * _UP[:len(piece)]).sum(dtype=np.uint64))) % 2**64
            found[at] = h
            at += 1
            continue
        sums = np.zeros(ends[to - 1] - first + 1, np.uint64)
        np.cumsum(_CODES[raw[first:ends[to - 1]]] * _UP[:len(sums) - 1], out=sums[1:])
        s, e = starts[at:to] - first, ends[at:to] - first
        found[at:to] = (sums[e] - sums[s]) * _DOWN[s]
        at = to
    return mix(found + (ends - starts).astype(np.uint64) * _MULTIPLIER), starts


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """The set of each text, sorted: hashes of `width` words in a row; of fewer words, one
    hash of the whole sequence; without words, nothing."""
    flat = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    hashes, starts = _word_hashes(flat)
    ends = np.cumsum([len(t) + 1 for t in texts])
    last = np.searchsorted(starts, ends)
    places = [pow(0xA24BAED4963EE407, i + 1, 2**64) for i in range(width)]
    rows = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for i, place in enumerate(places):
        rows += hashes[i:i + len(rows)] * np.uint64(place)
    rows, first = mix(rows), 0
    for to in last:
        n = to - first
        if n >= width:
            part = np.sort(rows[first:to - width + 1])
            keep = np.ones(len(part), bool)
            keep[1:] = part[1:] != part[:-1]
            yield part[keep]
        elif n:
            short = sum(int(h) * p for h, p in zip(hashes[first:to], places)) + int(n) * 0x2545F4914F6CDD1D
            yield mix(np.array([short % 2**64], np.uint64))
        else:
            yield rows[:0]
        first = to
