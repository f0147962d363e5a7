"""Words of whole texts as 64-bit hashes, for an Arrow column at a time.

A word's hash is the polynomial of its bytes, read off a running sum, so the cost
is a few array operations a byte. Words are runs of bytes other than the blank and
the control characters 9 to 13.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the distinct keys in ascending order: where one of each is, the inverse and the counts.

    ``np.unique`` finds the first of each by a stable sort, which takes several times as long.
    """
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    return order[begins], inverse, np.diff(begins, append=len(keys))


_BYTE = mixed(np.arange(256, dtype=np.uint64), 1)


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        for k, factor in enumerate((_BASE, _INVERSE)):
            factors = np.full(n, factor, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors)
    return _powers


def _totals(values: np.ndarray) -> np.ndarray:
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values * _power_tables(len(values) + 1)[0][: len(values)], out=total[1:])
    return total


def _runs(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = _power_tables(len(total))[1]
    length = (ends - starts).astype(np.uint64)
    return mixed((total[ends] - total[starts]) * inverse[starts] + length * _BASE)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` for each run, by content alone."""
    return _runs(_totals(values), starts, ends)


@dataclass
class Words:
    """``data``: the bytes; word ``w`` is ``data[starts[w]:ends[w]]``; row ``r`` has words
    ``first[r]`` to ``first[r + 1]`` and bytes ``bounds[r]`` to ``bounds[r + 1]``."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        if lower:
            return run_hashes(_BYTE[LOWER[self.data]], self.starts, self.ends)
        return self.byte_runs(self.starts, self.ends)

    def byte_runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each run."""
        return _runs(self._byte_totals, starts, ends)

    @cached_property
    def _byte_totals(self) -> np.ndarray:
        return _totals(_BYTE[self.data])

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and where each row begins; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(data: np.ndarray, bounds: np.ndarray) -> Words:
    inside = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    apart = np.empty(len(data) + 1, bool)
    apart[0] = apart[-1] = True
    np.logical_not(inside[:-1] & inside[1:], out=apart[1:-1]) if len(data) else None
    apart |= edge
    starts = np.flatnonzero(inside & apart[:-1])
    ends = np.flatnonzero(inside & apart[1:]) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))


def blocks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows ``[low, high)`` of about a quarter megabyte of text, or one row at a time."""
    low, n = 0, len(bounds) - 1
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + CHUNK_BYTES, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def chunks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, Words]]:
    """Rows ``[low, high)`` with their words, block by block."""
    data, bounds = text_bytes(column)
    for low, high in blocks(bounds):
        at = bounds[low : high + 1]
        yield low, high, split_words(data[at[0] : at[-1]], at - at[0])
