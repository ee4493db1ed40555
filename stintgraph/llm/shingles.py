"""Sets of word shingles as sorted arrays of 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

U64 = np.uint64
#: Odd multipliers of polynomial hashes modulo 2**64, and the inverse of the first.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_SPACE = np.array([x == 32 or 9 <= x <= 13 for x in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(4)
def _powers(size: int, of: int) -> np.ndarray:
    out = np.full(size, of, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, for i up to ``n`` at least."""
    size = 1 << max(16, n.bit_length())
    return _powers(size, BASE), _powers(size, INVERSE)


def forget() -> None:
    """Gives up the tables of powers; the next call makes them anew."""
    _powers.cache_clear()


def groups(texts: list[bytes], most: int = 1 << 20) -> Iterator[list[int]]:
    """Numbers of texts that are worked on together, of about ``most`` bytes."""
    at, held = [], 0
    for i, t in enumerate(texts):
        if at and held + len(t) > most:
            yield at
            at, held = [], 0
        at.append(i)
        held += len(t)
    if at:
        yield at


def words_within(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Starts, ends and 64-bit hashes of every text's words, ``[^\\x20\\x09-\\x0D]+`` as they stand."""
    for at in groups(texts):
        data = np.frombuffer(b" ".join([texts[i] for i in at]) + b" ", np.uint8)
        ups, downs = powers(len(data))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data]])))
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * ups[: len(data)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * downs[starts] + (ends - starts).astype(U64))
        first = np.cumsum([0, *(len(texts[i]) + 1 for i in at)])
        bounds = np.searchsorted(starts, first)
        for f, a, b in zip(first[:-1], bounds[:-1], bounds[1:], strict=True):
            yield starts[a:b] - f, ends[a:b] - f, hashes[a:b]


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of every text's shingles of ``width`` words. Words are
    ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A text of fewer words has one shingle, its whole
    sequence; one without words has none."""
    out: list[np.ndarray] = [np.empty(0, U64)] * len(texts)
    for at in groups(texts):
        data = np.frombuffer(b" ".join([texts[i] for i in at]).lower() + b" ", np.uint8)
        ups, downs = powers(len(data))
        blank = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * ups[: len(data)], out=sums[1:])
        words = mix((sums[ends] - sums[starts]) * downs[starts] + (ends - starts).astype(U64))
        lengths = np.array([len(texts[i]) + 1 for i in at])
        bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
        long = max(0, len(words) - width + 1)
        mixed = np.zeros(long, U64)
        for k in range(width):
            mixed = mixed * U64(BASE) + words[k : k + long]
        mixed = mix(mixed)
        for i, a, b in zip(at, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= width:
                out[i] = np.unique(mixed[a : b - width + 1])
            elif b > a:
                value = U64(b - a)
                with np.errstate(over="ignore"):
                    for w in words[a:b]:
                        value = value * U64(BASE) + w
                out[i] = mix(np.array([value], U64))
    return out
