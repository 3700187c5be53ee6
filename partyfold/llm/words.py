"""Words and hashes of whole Arrow text batches, in numpy.

A batch of texts is one byte array with offsets. Words are found and hashed for all texts
of a batch at once; nothing runs once per word in Python. Hashes are 64-bit: two different
words or shingles share one with a probability of about 2**-64 for each pair. They are not keyed: whoever
sets out to find two texts with one hash can.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_POWER = 0xD6E8FEB86659FD93

ASCII_LOWER = {upper: upper + 32 for upper in range(0x41, 0x5B)}


def mix(x: np.ndarray) -> np.ndarray:
    """Each value spread over all 64 bits, one to one."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as a bigint."""
    return x.view(np.int64)


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(_BASE))


_PERIOD = 1 << 18


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    both = []
    for base in (_POWER, pow(_POWER, -1, 1 << 64)):
        p = np.full(_PERIOD, base, U64)
        p[0] = 1
        both.append(np.cumprod(p, dtype=U64))
    return both[0], both[1]


class SpanHash:
    """Hashes of any spans of one array of symbols, from one running sum.

    A polynomial modulo 2**64 tells long spans badly apart (words of two letters that follow the parity of
    the bits of the places have one hash, whatever the base), so it only ever covers a block of
    64 symbols. The blocks of a longer span are mixed, each with its place, and added up.
    """

    BLOCK = 64

    def __init__(self, values: np.ndarray, symbols: np.ndarray | None = None):
        """`values` of the symbols one by one, or a table of values by symbol.

        The powers start anew after every `_PERIOD` symbols, so that their table is small.
        """
        self._forward, self._back = _powers()
        size = len(values) if symbols is None else len(symbols)
        self._sums = np.zeros(size + 1, U64)
        for start in range(0, size, _PERIOD):
            end = min(start + _PERIOD, size)
            own = values[start:end] if symbols is None else values[symbols[start:end]]
            out = self._sums[start + 1 : end + 1]
            np.cumsum(own * self._forward[: end - start], out=out)
            out += self._sums[start]

    def _block(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        place = starts & (_PERIOD - 1)
        raw = (self._sums[ends] - self._sums[starts]) * self._back[place]
        over = np.flatnonzero(place + (ends - starts) > _PERIOD)
        if len(over):  # the powers start anew inside these
            first, last = starts[over], ends[over]
            cut = (first | (_PERIOD - 1)) + 1
            before = (self._sums[cut] - self._sums[first]) * self._back[place[over]]
            raw[over] = before + (self._sums[last] - self._sums[cut]) * self._forward[cut - first]
        return mix(raw + (ends - starts).astype(U64) * U64(_BASE))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        long = np.flatnonzero(ends - starts > self.BLOCK)
        found = self._block(starts, np.minimum(ends, starts + self.BLOCK) if len(long) else ends)
        if len(long):
            first, last = starts[long], ends[long]
            blocks = -(-(last - first) // self.BLOCK)
            begins = np.cumsum(blocks) - blocks
            place = np.arange(int(blocks.sum())) - np.repeat(begins, blocks)
            start = np.repeat(first, blocks) + place * self.BLOCK
            own = self._block(start, np.minimum(start + self.BLOCK, np.repeat(last, blocks)))
            total = np.add.reduceat(mix(own ^ mix(place.astype(U64) + U64(1))), begins)
            found[long] = mix(total + (last - first).astype(U64) * U64(_BASE))
        return found


def lookup(separators: str, lower: bool = True, inverse: bool = False) -> np.ndarray:
    """A table from byte to symbol: 0 for what separates words, else the (lowered) byte.

    `separators` are the ASCII characters between words; with `inverse` they are the only
    ASCII characters in words. Bytes above 0x7F always belong to words.
    """
    table = np.arange(256, dtype=np.uint8)
    named = np.zeros(256, bool)
    named[[ord(c) for c in separators]] = True
    table[(~named if inverse else named) & (np.arange(256) < 128)] = 0
    table[0] = 0 if inverse or "\0" in separators else 255  # a word byte that no UTF-8 text has
    if lower:
        for upper, small in ASCII_LOWER.items():
            if table[upper] or table[small]:
                table[upper] = small
    return table


WHITE = lookup(" \t\n\v\f\r")
ALNUM = lookup("0123456789abcdefghijklmnopqrstuvwxyz", inverse=True)


@dataclass
class Texts:
    """Bytes of several texts, and where each begins and ends."""

    data: np.ndarray
    offsets: np.ndarray
    first_row: int

    @property
    def count(self) -> int:
        return len(self.offsets) - 1


def pieces(column: pa.Array, max_bytes: int = 1_900_000) -> Iterator[Texts]:
    """The texts of a column in portions of about `max_bytes`; null counts as empty.

    A text is never cut: a longer one is a portion of its own.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        limit = offsets[row] + max_bytes
        end = max(row + 1, int(np.searchsorted(offsets, limit, side="right")) - 1)
        end = min(end, len(column))
        lo, hi = offsets[row], offsets[end]
        yield Texts(data[lo:hi], offsets[row : end + 1] - lo, row)
        row = end


@dataclass
class Words:
    """Words of several texts: spans in bytes, and the words of each text as a range."""

    starts: np.ndarray
    ends: np.ndarray
    of_text: np.ndarray  # words of text i: of_text[i] to of_text[i + 1]
    symbols: np.ndarray

    def hashes(self) -> np.ndarray:
        return SpanHash(_byte_values(), self.symbols).of(self.starts, self.ends)


def words(texts: Texts, table: np.ndarray) -> Words:
    symbols = table[texts.data]
    inside = symbols != 0
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(inside):
        before[0] = after[-1] = False
        filled = texts.offsets[:-1] < texts.offsets[1:]
        before[texts.offsets[:-1][filled]] = False
        after[texts.offsets[1:][filled] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets), symbols)


def grams(hashes: np.ndarray, of_text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words within a text, and the text of each run."""
    counts = np.diff(of_text)
    runs = np.maximum(counts - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), runs)
    first = np.repeat(of_text[:-1] - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs)
    at = first + np.arange(len(text))
    return run_hash(hashes, at, size), text


def run_hash(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the `size` words from each position."""
    total = np.full(len(at), size, U64)
    factor = 1
    for k in range(size):
        factor = (factor * _POWER + 2 * k) % (1 << 64) | 1
        total += hashes[at + k] * U64(factor)
    return mix(total)
