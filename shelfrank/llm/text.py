"""Whole texts as byte arrays: words, lines and their hashes for many documents at once.

Everything here runs inside Arrow tasks.  A slice holds whole documents of a few megabytes
in all, so memory is bounded by the longest single text, not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 21
SLICE_TEXTS = 1024
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def slices(texts: pa.Array, limit: int = SLICE_BYTES, most: int = SLICE_TEXTS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, after last, bytes, offsets) of runs of whole texts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    count = len(texts)
    if not count:
        return
    _, where, raw = texts.buffers()
    ends = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + count + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    low = 0
    while low < count:
        high = int(np.searchsorted(ends, ends[low] + limit, side="right")) - 1
        high = min(count, low + most, max(high, low + 1))
        yield low, high, data[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every run of bytes that are no ASCII white space."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~SPACE[data]
    first = offsets[1:-1]
    first = first[first < len(data)]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    begins[first] = word[first]
    closes = word.copy()
    closes[:-1] &= ~word[1:]
    last = first[first > 0] - 1
    closes[last] = word[last]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(offsets, start, side="right") - 1


class SpanHasher:
    """64-bit hashes of byte spans from one running sum of weighted bytes."""

    def __init__(self) -> None:
        self.letters = mix64(np.arange(1, 257, dtype=np.uint64))
        self._grow(SLICE_BYTES + 1)

    def _grow(self, size: int) -> None:
        back = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.full(size, _BASE, dtype=np.uint64))
            self.down = np.cumprod(np.full(size, back, dtype=np.uint64))

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = len(data)
        if size + 1 > len(self.up):
            self._grow(size + 1)
        sums = np.zeros(size + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            weighted = self.letters[data]
            weighted *= self.up[:size]
            np.cumsum(weighted, out=sums[1:])
            return mix64((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))


#: One more than the largest hash of a draw.
DRAW_RANGE = 1 << 63


def draw_limit(share: float) -> int:
    """The largest hash that a share of the rows stays within; the smallest share still has a hash."""
    return max(1, int(DRAW_RANGE * min(1.0, share))) - 1


def draw_hash(*columns: str | Column) -> Column:
    """A hash of 63 bits by which rows are drawn."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(DRAW_RANGE - 1))
