"""Texts of Arrow batches as numpy arrays: bytes, words and polynomial hashes, many documents at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone. Arrays over it are eight times as large, and stay near the processor.
BLOCK = 1 << 18

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_GENERATOR = np.random.default_rng(20_240_229)


def _lowered(byte: np.ndarray) -> np.ndarray:
    return np.where((byte >= 0x41) & (byte <= 0x5A), byte + 0x20, byte)


#: One random number for every byte, and the same with A-Z read as a-z.
BYTES = _GENERATOR.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = BYTES[_lowered(np.arange(256))]

IN_WORD = ~np.isin(np.arange(256), list(SPACES))
#: Digits, letters and everything beyond ASCII.
IN_PLAIN_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row begins (one more at the end). A null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of rows of about `size` bytes."""
    data, offsets = raw(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads what differs anywhere in a number over all its bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


PRIME = np.uint64((1 << 61) - 1)
_LOW30, _LOW31 = np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)
_1, _30, _31, _61 = (np.uint64(k) for k in (1, 30, 31, 61))
#: Numbers multiplied at once: what comes in between stays near the processor.
_CHUNK = 1 << 13


def _reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit number modulo PRIME. Of x and x - PRIME the lesser one is right, as the latter wraps round below 0."""
    x = (x & PRIME) + (x >> _61)
    return np.minimum(x, x - PRIME)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME for numbers up to it, by halves: 2^61 counts as one."""
    out = np.empty(len(a), np.uint64)
    for lo in range(0, len(a), _CHUNK):
        x, y = a[lo : lo + _CHUNK], b[lo : lo + _CHUNK] if len(b) > 1 else b
        xh, xl, yh, yl = x >> _31, x & _LOW31, y >> _31, y & _LOW31
        middle = xh * yl
        middle += xl * yh
        xh *= yh
        xh <<= _1
        xl *= yl
        xh += xl
        xh += middle >> _30
        middle &= _LOW30
        middle <<= _31
        xh += middle
        out[lo : lo + _CHUNK] = _reduced(xh)
    return out


class Polynomial:
    """Hashes of any run of a sequence from prefix sums: sum of symbol * base^place modulo 2^61 - 1, moved to place 0.

    Modulo a prime no structure of a text makes two runs collide more often than chance does; modulo a power of two it can, whatever the base.
    """

    def __init__(self, base: int):
        p = int(PRIME)
        self._base, self._inverse = base % p, pow(base % p, -1, p)
        self._powers = self._back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self._powers) < n:
            k = len(self._powers)
            step, back = (np.array([pow(x, k, int(PRIME))], np.uint64) for x in (self._base, self._inverse))
            self._powers = np.concatenate([self._powers, _times(self._powers, step)])
            self._back = np.concatenate([self._back, _times(self._back, back)])

    def prefixes(self, symbols: np.ndarray) -> np.ndarray:
        self._grow(len(symbols) + 1)
        terms = _times(symbols & PRIME, self._powers[: len(symbols)])
        out = np.zeros(len(symbols) + 1, np.uint64)
        high = low = np.uint64(0)
        for lo in range(0, len(terms), _CHUNK):
            part = terms[lo : lo + _CHUNK]
            # Summed by halves, which do not overflow; the upper one counts 2^30 times: turned round by 30 of 61 bits.
            highs, lows = _reduced(np.cumsum(part >> _30) + high), _reduced(np.cumsum(part & _LOW30) + low)
            high, low = highs[-1], lows[-1]
            out[lo + 1 : lo + len(part) + 1] = _reduced((((highs << _30) & PRIME) | (highs >> _31)) + lows)
        return out

    def _moved(self, after: np.ndarray, before: np.ndarray, back: np.ndarray) -> np.ndarray:
        apart = after + (PRIME - before)
        return _times(np.minimum(apart, apart - PRIME), back)

    def runs(self, prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._moved(prefixes[ends], prefixes[starts], self._back[starts])

    def windows(self, prefixes: np.ndarray, length: int) -> np.ndarray:
        """Of every run of this length."""
        n = max(0, len(prefixes) - length)
        return self._moved(prefixes[length:], prefixes[:n], self._back[:n])


SYMBOLS = Polynomial(0x9E3779B97F4A7C15)
WORDS = Polynomial(0xD1342543DE82EF95)


@dataclass
class Words:
    """Words of a block: where they are in its bytes, and which are whose (offsets by document, one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def hashes(self, data: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
        """64 bits for each word; equal words have equal ones in any block."""
        sums = SYMBOLS.prefixes(table[data])
        return mixed(SYMBOLS.runs(sums, self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray = IN_WORD) -> Words:
    inside = alphabet[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]  # a word ends where its document does
    first[filled] = inside[filled]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return Words(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))
