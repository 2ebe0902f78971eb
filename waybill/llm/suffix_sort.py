"""Sorts suffixes by hash-compared mergesort: prefix hashes and binary search give common extensions, bytes confirm them."""

from __future__ import annotations

import numpy as np

from waybill.llm.text import BYTES, SYMBOLS


class Suffixes:
    """Suffixes of one buffer, compared on their first `depth` bytes (all of which have to be there)."""

    def __init__(self, data: np.ndarray, depth: int):
        self.data, self.depth = data, depth
        self._sums = SYMBOLS.prefixes(BYTES[data])
        self._runs = SYMBOLS.runs

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes a and b, by binary search over hashes of their beginnings."""
        lo, hi = np.zeros(len(a), np.int64), np.full(len(a), self.depth)
        while len(open_ := np.flatnonzero(lo < hi)):
            x, y, middle = a[open_], b[open_], (lo[open_] + hi[open_] + 1) // 2
            same = self._runs(self._sums, x, x + middle) == self._runs(self._sums, y, y + middle)
            lo[open_] = np.where(same, middle, lo[open_])
            hi[open_] = np.where(same, hi[open_], middle - 1)
        return lo

    def before(self, a: np.ndarray, b: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix a goes before suffix b; `ties` says what holds for equal ones."""
        n = self.common(a, b)
        differ = n < self.depth
        at = np.where(differ, n, 0)
        return np.where(differ, self.data[a + at] < self.data[b + at], ties)

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """An order of `at` by group, then suffix. Merges pairs of runs of all groups at once, each element finding its rank by binary search."""
        order = np.argsort(group, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0])) if len(at) else np.empty(0, np.int64)
        size = np.diff(np.append(first, len(at)))
        begin, count = np.repeat(first, size), np.repeat(size, size)
        inside = np.arange(len(at)) - begin
        width = 1
        while len(at) and width < size.max():
            pair = inside // (2 * width) * (2 * width)
            left = inside - pair < width
            other = begin + pair + np.where(left, width, 0)
            lo = np.minimum(other, begin + count)
            end = np.minimum(lo + width, begin + count)
            moving = np.flatnonzero((lo < end) & (begin + pair + width < begin + count))
            start, hi = lo.copy(), end.copy()
            hi[np.setdiff1d(np.arange(len(at)), moving, assume_unique=True)] = 0
            while len(open_ := moving[lo[moving] < hi[moving]]):
                middle = (lo[open_] + hi[open_]) // 2
                mine, theirs = at[order[open_]], at[order[middle]]
                # Of equals, those of the left run stay in front.
                ahead = np.where(left[open_], self.before(theirs, mine, False), self.before(theirs, mine, True))
                lo[open_] = np.where(ahead, middle + 1, lo[open_])
                hi[open_] = np.where(ahead, hi[open_], middle)
            to = np.arange(len(at))
            rank = inside[moving] - pair[moving] - np.where(left[moving], 0, width) + lo[moving] - start[moving]
            to[moving] = begin[moving] + pair[moving] + rank
            merged = np.empty_like(order)
            merged[to] = order
            order, width = merged, 2 * width
        return order

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffixes a and b really agree on all their bytes: what hashes call equal is read again."""
        out, step = np.empty(len(a), bool), max(1, (1 << 22) // self.depth)
        reach = np.arange(self.depth)
        for k in range(0, len(a), step):
            x, y = a[k : k + step, None] + reach, b[k : k + step, None] + reach
            out[k : k + step] = (self.data[x] == self.data[y]).all(axis=1)
        return out

    def repeated(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Which suffixes share all `depth` bytes with another one of their group."""
        order = self.sort(at, group)
        a, b = at[order[:-1]], at[order[1:]]
        near = np.flatnonzero(group[order[:-1]] == group[order[1:]])
        near = near[self.common(a[near], b[near]) == self.depth]
        good = self.equal(a[near], b[near])
        out = np.zeros(len(at), bool)
        out[order[near[good]]] = out[order[near[good] + 1]] = True
        for g in np.unique(group[order[near[~good]]]):  # two texts with one hash: their group is compared by its bytes
            members = np.flatnonzero(group == g)
            seen: dict[bytes, list[int]] = {}
            for m in members:
                seen.setdefault(self.data[at[m] : at[m] + self.depth].tobytes(), []).append(m)
            for same in seen.values():
                out[same] = len(same) > 1
        return out
