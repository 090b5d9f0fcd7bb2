"""Winnowed anchors: content-chosen places that split a sequence's windows into fragments.

Every window of ``size`` symbols picks the smallest hash among its runs of ``span`` symbols, the first one on
ties. Windows that pick the same place are neighbours; with the symbols they cover they form a fragment. Equal
windows pick equal anchors at equal places, wherever they stand, so windows can only be equal if their anchors
are, and a group of equal anchors holds every copy of its windows.
"""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    out = values * _MIX
    out ^= out >> np.uint64(31)
    out *= _BASE
    out ^= out >> np.uint64(29)
    return out


def run_hashes(symbols: np.ndarray, span: int) -> np.ndarray:
    """Hashes of all runs of ``span`` symbols, from the hashes of runs of powers of two."""
    parts, at, width, level = None, 0, 1, symbols
    while True:
        if span & width:
            tail = level[at : at + len(symbols) - span + 1]
            parts = tail.copy() if parts is None else mixed(parts) + tail
            at += width
        if at == span:
            return mixed(parts)
        level = mixed(level[:-width]) + level[width:]
        width *= 2


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every run of ``width`` values."""
    power, level = 1, values
    while power * 2 <= width:
        level = np.minimum(level[:-power], level[power:])
        power *= 2
    rest = width - power
    return np.minimum(level[: len(level) - rest], level[rest:]) if rest else level


def fragments(symbols: np.ndarray, left: np.ndarray, size: int, span: int):
    """Anchor hash, anchor place, first window and number of windows of every fragment.

    ``left`` tells how many symbols of its own document each place has from there on; a window must not cross
    into the next document.
    """
    none = np.zeros(0, np.int64)
    if len(symbols) < size:
        return np.zeros(0, np.uint64), none, none, none
    hashes = run_hashes(symbols, span)
    # the place in the low bits makes the first of equal hashes the smallest of a window and tells where it is
    place_bits = np.uint64(127)
    turn = np.arange(len(hashes), dtype=np.uint64) & place_bits
    least = window_minima((hashes & ~place_bits) | turn, size - span + 1) & place_bits
    starts = np.arange(len(least), dtype=np.int64)
    place = starts + ((least.astype(np.int64) - starts) & 127)
    inside = np.flatnonzero(left[: len(least)] >= size)
    if not len(inside):
        return np.zeros(0, np.uint64), none, none, none
    own = place[inside]
    head = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (inside[1:] != inside[:-1] + 1)])
    return hashes[own[head]], own[head], inside[head], np.diff(np.r_[head, len(inside)])


class RangeHash:
    """Hashes of any range of a sequence, from prefix sums of a polynomial."""

    def __init__(self, symbols: np.ndarray):
        self.inverse = _powers(len(symbols) + 1)
        terms = mixed(symbols) * self.inverse[: len(symbols)]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        self.back = _back_powers(len(symbols) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


_FORWARD = np.uint64(0xD1342543DE82EF95)
_BACKWARD = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_tables: dict[int, np.ndarray] = {}


def _table(base: np.uint64, length: int) -> np.ndarray:
    known = _tables.get(int(base))
    if known is None or len(known) < length:
        known = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(length, 1 << 16), base)]), dtype=np.uint64)
        _tables[int(base)] = known
    return known[:length]


def _powers(length: int) -> np.ndarray:
    return _table(_FORWARD, length)


def _back_powers(length: int) -> np.ndarray:
    return _table(_BACKWARD, length)
