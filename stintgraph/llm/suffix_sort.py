"""Suffixes compared by polynomial prefix hashes, sorted by merging.

The hash of any part of a buffer comes from two prefix sums, so a binary search over lengths finds a
common extension in a logarithmic number of hash comparisons. All comparisons of a step of the
mergesort are made at once, as arrays. Hashes only propose; ``same_bytes`` decides.
"""

from __future__ import annotations

import numpy as np

from stintgraph.llm.shingles import U64, powers


class Suffixes:
    """Suffixes of ``data`` that begin at ``at`` and are ``length`` long at most, of ``group``s that
    aren't compared with each other (all of one group before the next)."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: np.ndarray, group: np.ndarray) -> None:
        self.data, self.at, self.length, self.group = data, at, length, group
        self.ups, self.downs = powers(len(data))
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * self.ups[: len(data)], out=self.sums[1:])

    def hashes(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.downs[at]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Lengths of the common beginnings of suffixes ``x`` and ``y``, by binary search."""
        a, b = self.at[x], self.at[y]
        low, high = np.zeros(len(x), np.int64), np.minimum(self.length[x], self.length[y])
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            same = self.hashes(a, mid) == self.hashes(b, mid)
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)
        return low

    def compare(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1, by group, then by bytes, then by length."""
        out = np.sign(self.group[x] - self.group[y])
        own = np.flatnonzero(out == 0)
        if len(own):
            x, y = x[own], y[own]
            n = self.common(x, y)
            rest = np.minimum(self.length[x], self.length[y]) > n
            last = len(self.data) - 1
            a, b = self.data[np.minimum(self.at[x] + n, last)].astype(np.int64), self.data[np.minimum(self.at[y] + n, last)].astype(np.int64)
            out[own] = np.sign(np.where(rest, a - b, self.length[x] - self.length[y]))
        return out

    def sort(self) -> np.ndarray:
        """Order of the suffixes by mergesort: in each step every element finds its place in the
        run beside its own by binary search."""
        n = len(self.at)
        order, width, pos = np.arange(n), 1, np.arange(n)
        while width < n:
            run = pos // width
            right = (run & 1) == 1
            first = np.minimum(np.where(right, run - 1, run + 1) * width, n)
            low, high = first.copy(), np.minimum(first + width, n)
            # runs of different groups need no search: groups stand in order from the start
            while len(open_ := np.flatnonzero(low < high)):
                mid = (low[open_] + high[open_]) // 2
                sign = self.compare(order[mid], order[open_])
                before = (sign < 0) | (right[open_] & (sign == 0))
                low[open_[before]] = mid[before] + 1
                high[open_[~before]] = mid[~before]
            place = (run // 2) * 2 * width + (pos - run * width) + (low - first)
            merged = np.empty_like(order)
            merged[place] = order
            order, width = merged, width * 2
        return order


def same_bytes(data: bytes, x: int, y: int, n: int) -> bool:
    return data[x : x + n] == data[y : y + n]


def sliding(least_or_most: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """Over every ``width`` consecutive elements, by doubling."""
    size = 1
    while size * 2 <= width:
        x = least_or_most(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return least_or_most(x[:-rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, bounds: list[tuple[int, int]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of anchors in the texts ``bounds`` of ``data``: of every string of ``length``
    bytes within a text, the parts of half that length with the least hash. Equal strings have equal
    anchors, at the same places in them."""
    half = length // 2
    width = length - half + 1
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, U64)
    ups, downs = powers(len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * ups[: len(data)], out=sums[1:])
    h = (sums[half:] - sums[:-half]) * downs[: len(data) - half + 1]
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    np.maximum(h, U64(1), out=h)
    least = sliding(np.minimum, h, width)
    valid = np.zeros(len(least), bool)
    for a, b in bounds:
        if b - a >= length:
            valid[a : b - length + 1] = True
    least[~valid] = 0
    around = np.concatenate([np.zeros(width - 1, U64), least, np.zeros(width - 1, U64)])
    chosen = np.flatnonzero(sliding(np.maximum, around, width)[: len(h)] == h)
    return chosen, h[chosen]


def repeated_windows(texts: list[bytes], anchor: np.ndarray, group: np.ndarray, length: int) -> list[np.ndarray]:
    """Of contexts, each a stretch of a text around an anchor (``anchor``: its place in the context),
    the starts of windows of ``length`` bytes around the anchor that occur at the same distance from
    the anchor in another context of the group. Groups stand one behind the other.

    Suffixes from the anchor on, and the reversed ones before it, are sorted; neighbours give how far a
    context agrees with any other to either side, so which windows can occur elsewhere at all, and
    neighbouring pairs show most that do. Only windows left open then are compared one by one.
    """
    n = len(texts)
    data = b"".join(texts)
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size) - size
    at = start + anchor
    forward = Suffixes(np.frombuffer(data, np.uint8), at, size - anchor, group)
    backward = Suffixes(np.frombuffer(data, np.uint8)[::-1], len(data) - at, anchor, group)
    every = np.arange(n)
    reach, partners = [], []
    for side in (forward, backward):
        order = side.sort()
        x, y = order[:-1], order[1:]
        same = group[x] == group[y]
        x, y = x[same], y[same]
        far = side.common(x, y)
        most = np.full(n, -1)
        np.maximum.at(most, x, far)
        np.maximum.at(most, y, far)
        reach.append(most)
        partners += [(x, y), (y, x)]
    # windows are told by j, the distance from their start to the anchor
    j = np.arange(length)
    widest = int(anchor.max(initial=0))
    j = np.arange(min(widest, length - 1) + 1)
    can = (j >= (length - reach[0])[:, None]) & (j <= reach[1][:, None])
    found = np.zeros_like(can)
    for x, y in partners:
        low, high = length - forward.common(x, y), np.minimum(backward.common(x, y), len(j) - 1)
        for a, b, lo, hi in zip(*(v[low <= high].tolist() for v in (x, y, low, high)), strict=True):
            if not found[a, lo : hi + 1].all() and same_bytes(data, int(at[a]) - hi, int(at[b]) - hi, hi - lo + length):
                found[a, lo : hi + 1] = True
    left = can & ~found
    if left.any():
        asked = np.zeros((int(group.max()) + 1, len(j)), bool)
        who, what = np.nonzero(left)
        asked[group[who], what] = True
        who, what = np.nonzero(can & asked[group[every]])
        h = forward.hashes(at[who] - what, np.full(len(who), length))
        order = np.lexsort((who, h, what, group[who]))
        who, what, h = who[order], what[order], h[order]
        new = np.ones(len(who), bool)
        new[1:] = (group[who[1:]] != group[who[:-1]]) | (what[1:] != what[:-1]) | (h[1:] != h[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        for k in np.flatnonzero(~new):
            a, b, d = int(who[k]), int(who[first[k]]), int(what[k])
            if same_bytes(data, int(at[a]) - d, int(at[b]) - d, length):
                found[a, d] = found[b, d] = True
    return [anchor[i] - np.flatnonzero(found[i]) for i in range(n)]
