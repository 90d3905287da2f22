"""Content-chosen anchors: every window of LENGTH bytes is named by the least-hashed GRAM-byte string in it."""

from __future__ import annotations

import numpy as np

from .shingles import _BASE, _BYTE, _UNBASE, _powers, mix

LENGTH = 50
GRAM = 20
#: Positions are kept in so many low bits of a hash; texts of more bytes take a slower way to the same anchors.
PLACE = 20

_TABLES: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """The first n powers of base, from a table that grows."""
    t = _TABLES.get(base)
    if t is None or len(t) < n:
        t = _TABLES[base] = _powers(base, max(n, 1 << 17))
    return t[:n]


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the gram bytes at each position that has so many."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power_table(_BASE, len(data)), out=sums[1:])
    h = sums[gram:] - sums[:-gram]
    h *= _power_table(_UNBASE, len(h))
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def least_in_span(h: np.ndarray, span: int) -> np.ndarray:
    """Position of the least of h[i : i + span] without its PLACE low bits, the first of equal ones, for each i."""
    low = np.uint64((1 << PLACE) - 1)
    if len(h) > 1 << PLACE:
        step = (1 << PLACE) - span
        return np.concatenate([least_in_span(h[a : a + step + span - 1], span) + a for a in range(0, len(h) - span + 1, step)])
    best = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width < span:
        step = min(width, span - width)
        best = np.minimum(best[step:], best[:-step])
        width += step
    return (best & low).astype(np.int64)


def anchors(data: np.ndarray, ends: np.ndarray, gram: int = GRAM, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, first window, last window, hash) of each anchor of the texts that data holds one after another up to `ends`.

    An anchor's windows are a range. Texts shorter than length have none. Equal windows have their anchors at
    equal offsets, wherever they are.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64)
    h = gram_hashes(data, gram)
    where = least_in_span(h, length - gram + 1)
    whole = np.ones(len(data), bool)  # windows that end in the text they start in
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        whole[max(a, b - length + 1) : b] = False
    windows = np.flatnonzero(whole[: len(where)])
    if not len(windows):
        return none, none, none, none.astype(np.uint64)
    where = where[windows]
    cut = np.flatnonzero(where[1:] != where[:-1]) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut - 1, [len(windows) - 1]])
    at = where[first]
    return at, windows[first], windows[last], h[at]


class Prefix:
    """Hashes of any substrings of data."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power_table(_BASE, len(data)), out=self.sums[1:])
        self.back = _power_table(_UNBASE, len(data) + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        """64-bit hashes of data[start:end] and salt."""
        h = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(h ^ mix(np.asarray(salt, np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
