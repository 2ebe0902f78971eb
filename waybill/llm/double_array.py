"""A double-array trie over sequences of numbers, walked from all places of a text at once.

Node s has a child under symbol c at slot base[s] + c, if check there is s. The root's children are in the first slots, in order of their symbols.
Below them a symbol is two steps, its upper bits and its lower ones: children of a node are then near each other and fit between those of others,
however many symbols there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Symbol that no sequence has; nothing goes over it.
BREAK = 0
#: Bits of the lower step.
BITS = 9
_LOWER = (1 << BITS) - 1
#: Free slots that a node with several children looks at, and the last slots among which they are sought.
_LOOK, _LAST = 4096, 1 << 16
#: Bytes of a slot in the arrays of a trie.
_SLOT = 12


class TooLarge(Exception):
    """The arrays would grow beyond the bytes allowed."""


@dataclass
class DoubleArray:
    """base and check by slot, and the number of the sequence that ends there (-1: none)."""

    root: int
    base: np.ndarray
    check: np.ndarray
    accepts: np.ndarray

    @property
    def nbytes(self) -> int:
        return self.base.nbytes + self.check.nbytes + self.accepts.nbytes

    @classmethod
    def build(cls, sequences: np.ndarray, most: int | None = None) -> DoubleArray:
        """Of distinct sequences in ascending order, one a row, filled up with BREAK; each is known by its row number. `most`: bytes beyond which it is given up (TooLarge)."""
        n, depth = sequences.shape
        first = int(sequences[:, 0].min()) if n else 1
        root = int(sequences[:, 0].max()) - first + 1 if n else 0
        slots = _Slots(root + 1, None if most is None else most // _SLOT)
        slots.base[root], slots.taken[root] = -first, True
        state, accepted = np.full(n, root, np.int32), []
        for level in range(depth):
            alive = np.flatnonzero(sequences[:, level] != BREAK)
            if not len(alive):
                break
            symbols = sequences[alive, level]
            if level == 0:
                slots.put(root, symbols, -first)
                state[alive] = symbols - first
            else:
                state[alive] = slots.put_all(state[alive], symbols >> BITS)
                state[alive] = slots.put_all(state[alive], symbols & _LOWER)
            ends = alive if level == depth - 1 else alive[sequences[alive, level + 1] == BREAK]
            accepted.append((state[ends].copy(), ends))
        accepts = np.full(slots.used, -1, np.int32)
        for at, number in accepted:
            accepts[at] = number
        return cls(root, slots.base[: slots.used].copy(), slots.check[: slots.used].copy(), accepts)

    def walk(self, symbols: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, states) level by level: where a path of 1, 2, ... symbols begins, and the node it leads to."""
        places = np.flatnonzero(symbols != BREAK)
        states = np.full(len(places), self.root)
        for level in range(depth):
            inside = places + level < len(symbols)
            places, states = places[inside], states[inside]
            symbol = symbols[places + level]
            if level:
                goes = symbol != BREAK
                places, states, symbol = places[goes], states[goes], symbol[goes]
                found, states = self._step(states, symbol >> BITS)
                places, symbol = places[found], symbol[found] & _LOWER
            found, states = self._step(states, symbol)
            places = places[found]
            yield places, states

    def _step(self, states: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes have a child under their symbol, and these children."""
        slot = self.base[states] + symbol
        # A slot that is not there is read as some other one.
        at = np.clip(slot, 0, len(self.check) - 1)
        found = (self.check[at] == states) & (at == slot)
        return found, slot[found]


class _Slots:
    """The arrays while they grow."""

    def __init__(self, used: int, most: int | None = None):
        self.used, self._most = used, most
        if most is not None and used > most:
            raise TooLarge
        self.base, self.check, self.taken = np.zeros(used, np.int32), np.full(used, -1, np.int32), np.zeros(used, bool)
        self._free, self._since = np.empty(0, np.int64), 0

    def _reach(self, end: int) -> None:
        if self._most is not None and end > self._most:
            raise TooLarge
        if end > len(self.base):
            more = max(end, len(self.base) + len(self.base) // 2) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])
            self.taken = np.concatenate([self.taken, np.zeros(more, bool)])
        self.used = max(self.used, end)

    def put_all(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Gives children to nodes; rows of a node are together, its symbols ascending and repeated. The child of every row."""
        new = np.concatenate([[True], (parents[1:] != parents[:-1]) | (symbols[1:] != symbols[:-1])])
        one, each = parents[new], symbols[new]
        begins = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]]))
        counts = np.diff(np.append(begins, len(one)))
        # Nodes with many children go first; those with one take any slot that is left.
        for k in np.argsort(-counts, kind="stable")[: int((counts > 1).sum())].tolist():
            own = each[begins[k] : begins[k] + counts[k]]
            self.put(int(one[begins[k]]), own, self.fit(own))
        lone = begins[counts == 1]
        self.put_lone(one[lone], each[lone])
        return self.base[parents] + symbols

    def fit(self, symbols: np.ndarray) -> int:
        """A base that puts all symbols into free slots."""
        if self._since % 64 == 0:
            begin = max(0, self.used - _LAST)
            self._free = begin + np.flatnonzero(~self.taken[begin : self.used])[-_LOOK:]
        self._since += 1
        bases = self._free - int(symbols[0])
        for c in symbols.tolist():
            if not len(bases):
                break
            at = bases + c
            bases = bases[(at >= self.used) | ~self.taken[np.minimum(at, self.used - 1)]]
        return int(bases[0]) if len(bases) else self.used - int(symbols[0])

    def put(self, parent: int, symbols: np.ndarray, base: int) -> None:
        self._reach(base + int(symbols[-1]) + 1)
        self.base[parent] = base
        self.check[base + symbols] = parent
        self.taken[base + symbols] = True

    def put_lone(self, parents: np.ndarray, symbols: np.ndarray) -> None:
        at = np.flatnonzero(~self.taken[: self.used])[: len(parents)]
        at = np.concatenate([at, self.used + np.arange(len(parents) - len(at))])
        if len(at):
            self._reach(int(at.max()) + 1)
            self.base[parents] = at - symbols
            self.check[at], self.taken[at] = parents, True
