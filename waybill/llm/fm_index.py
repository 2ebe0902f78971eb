"""An FM-index in numpy: suffix order by rank doubling, ranks by a wavelet matrix, places by sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: Every so many text positions one is kept for locating.
_SAMPLE = 8


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Of a text of integers in which no two suffixes agree to the end. Doubles the length that ranks tell apart until all differ."""
    n, reach = len(ranks), 1
    while True:
        later = np.zeros(n, np.int64)
        later[: n - reach] = ranks[reach:] + 1
        key = ranks * (ranks.max() + later.max() + 2) + later
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        ranks = np.empty(n, np.int64)
        ranks[order] = new
        if new[-1] == n - 1:
            return order
        reach *= 2


class Wavelet:
    """Ranks and symbols of a sequence of small integers, a bit of the symbol a level."""

    def __init__(self, symbols: np.ndarray, top: int):
        self._levels: list[tuple[int, np.ndarray, int]] = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1
            counts = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=counts[1:])
            self._levels.append((bit, counts, len(symbols) - int(counts[-1])))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol is before each place."""
        first, last = np.zeros(len(end), np.int64), end.astype(np.int64)
        for bit, counts, zeros in self._levels:
            one = ((symbol >> bit) & 1).astype(bool)
            a, b = counts[first], counts[last]
            first, last = np.where(one, zeros + a, first - a), np.where(one, zeros + b, last - b)
        return last - first

    def at(self, place: np.ndarray) -> np.ndarray:
        out, place = np.zeros(len(place), np.int64), place.astype(np.int64)
        for _, counts, zeros in self._levels:
            a = counts[place]
            one = counts[place + 1] > a
            out = out * 2 + one
            place = np.where(one, zeros + a, place - a)
        return out


class FMIndex:
    """An index of runs of symbols from 1 to `top`; a match lies within one run."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, top: int):
        """symbols: of all runs, one after the other."""
        ends = np.cumsum(lengths)
        n = len(symbols) + len(lengths)
        stop = ends + np.arange(len(lengths))  # each run is followed by a mark of its own, smaller than any symbol
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[stop] = False
        text[inside] = symbols
        marks = len(lengths)
        ranks = text + marks
        ranks[stop] = np.arange(marks)
        order = suffix_order(ranks)
        self._wavelet = Wavelet(text[order - 1], top)
        self._before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self._n = n
        # Positions at a fixed distance, and where a run begins: no walk leaves its run.
        begin = np.zeros(n, bool)
        begin[0] = True
        begin[stop[:-1] + 1] = True
        self._sampled = (order % _SAMPLE == 0) | begin[order]
        self._samples = np.cumsum(self._sampled) - 1
        self._positions = order[self._sampled]
        self._place = np.cumsum(inside) - 1  # in the caller's symbols

    def _step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self._before[symbol] + self._wavelet.rank(symbol, row)

    def count(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of suffixes that begin with each pattern, by backward search. patterns: right-aligned in a matrix."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self._n)
        present = np.diff(self._before) > 0
        absent = ~present[patterns] & (np.arange(patterns.shape[1]) >= patterns.shape[1] - lengths[:, None])
        alive = np.flatnonzero(~absent.any(axis=1))
        hi[absent.any(axis=1)] = 0
        for k in range(1, patterns.shape[1] + 1):
            alive = alive[lo[alive] < hi[alive]]
            now = alive[lengths[alive] >= k]
            if not len(now):
                break
            symbol = patterns[now, -k]
            lo[now], hi[now] = self._step(symbol, lo[now]), self._step(symbol, hi[now])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where, in the caller's symbols, the suffixes of these rows begin: walk back to a sampled position."""
        row, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            there = self._sampled[row[open_]]
            done = open_[there]
            out[done] = self._positions[self._samples[row[done]]] + steps[done]
            open_ = open_[~there]
            row[open_] = self._step(self._wavelet.at(row[open_]), row[open_])
            steps[open_] += 1
        return self._place[out]
