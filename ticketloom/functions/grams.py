"""Hashed character trigrams of whole texts, an Arrow column at a time."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BUCKETS = 1 << 13
FACTOR = 31
_BLOCK_CHARS = 1 << 18
_LETTERS = np.array([unicodedata.category(chr(c)).startswith("L") for c in range(1 << 16)])


def _blocks(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about a quarter million characters, or one text at a time."""
    ends, low = np.cumsum(lengths), 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + _BLOCK_CHARS, side="right")))
        yield low, high
        low = high


def trigram_buckets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For blocks of texts: the buckets of their trigrams, and where each text's begin.

    Every letter of the lower-cased text is the middle of a trigram; a neighbour that is not
    a letter, or beyond the basic plane, counts as a blank. NULL counts as empty.
    """
    texts = texts.cast(pa.large_string())
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    for low, high in _blocks(sizes):
        lower = pc.utf8_lower(pc.fill_null(texts.slice(low, high - low), ""))
        lengths = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        joined = "\0" + "\0".join(lower.to_pylist()) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _LETTERS[np.minimum(points, 0xFFFF)] & (points <= 0xFFFF)
        middle = np.flatnonzero(letter)
        shown = np.where(letter, points, 32).astype(np.int64)
        buckets = ((shown[middle - 1] * FACTOR + shown[middle]) * FACTOR + shown[middle + 1]) % BUCKETS
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        yield buckets, np.searchsorted(middle, bounds + 1)
