"""Sets of hashed word shingles, many texts at a time."""

from __future__ import annotations

import numpy as np

WIDTH = 5
#: Bytes hashed at once; a longer text is a batch of its own.
CHUNK = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _rng.integers(1, 2**64 - 1, 256, np.uint64)
_BASE, _JOIN = (int(x) | 1 for x in _rng.integers(1, 2**63, 2, np.uint64))
_UNBASE = pow(_BASE, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[:1] = 1
    return np.cumprod(x, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each run of bytes other than white space, A-Z lower-cased; data ends in white space."""
    low = _LOWER[data]
    word = ~_SPACE[low]
    edge = np.flatnonzero(np.diff(word, prepend=False))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE[low] * _powers(_BASE, len(low)), dtype=np.uint64, out=sums[1:])
    back = _powers(_UNBASE, len(low))
    return starts, mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def _group(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    starts, words = _words(data)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    cuts = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])).tolist()
    join = np.uint64(_JOIN)
    if len(words) >= WIDTH:
        h = words[: len(words) - WIDTH + 1].copy()
        for k in range(1, WIDTH):
            h = h * join + words[k : len(words) - WIDTH + 1 + k]
        h = mix(h)
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b - a >= WIDTH:
            out.append(np.unique(h[a : b - WIDTH + 1]))
        elif b > a:  # fewer words: the whole sequence
            x = np.uint64(b - a)
            for w in words[a:b]:
                x = mix(np.array([x * join + w]))[0]
            out.append(np.array([x], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[bytes]):
    """The sorted set of hashed 5-word shingles of each UTF-8 text, in order."""
    with np.errstate(over="ignore"):
        group, size = [], 0
        for t in texts:
            if group and size + len(t) > CHUNK:
                yield from _group(group)
                group, size = [], 0
            group.append(t)
            size += len(t) + 1
        if group:
            yield from _group(group)


def similar(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted sets."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)
