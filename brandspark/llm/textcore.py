"""Vectorised text primitives on Arrow batches: words, lines, hashes.

Everything works on the UTF-8 bytes of a slice of rows at once (numpy), so no
Python runs per word.  Slices are bounded by bytes, which bounds the memory of
a task whatever the length of its documents (one document is the least unit).

Hashes are 64-bit keyed polynomials with a final mix; equality of two strings
is taken as equality of length and hash where the docstring of an operator
says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space of the word definition ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_RNG = np.random.default_rng(20240501)
BYTE_KEY = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256)
LOWER[65:91] += 32
BYTE_KEY_LOWER = BYTE_KEY[LOWER]
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 1 << 19


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text of each has about ``limit`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, concatenated, and the offsets of the rows; null is empty."""
    array = pc.fill_null(array.cast(pa.large_string()), "")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """The first powers of a number; those beyond ``kept`` are worked out anew, so that workers hold no more."""

    def __init__(self, base: np.uint64, kept: int = 1 << 16):
        self.base = base
        self.table = self._first(kept)

    def _first(self, n: int) -> np.ndarray:
        p = np.ones(n, dtype=np.uint64)
        known, factor = 1, int(self.base)  # factor is base ** known
        while known < n:
            more = min(known, n - known)
            np.multiply(p[:more], np.uint64(factor), out=p[known : known + more])
            known, factor = known + more, factor * factor % 2**64
        return p

    def __call__(self, n: int) -> np.ndarray:
        return self.table[:n] if n <= len(self.table) else self._first(n)


powers = Powers(MULTIPLIER)


def span_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: np.ndarray = BYTE_KEY) -> np.ndarray:
    """Hash of each span; spans are sorted and don't overlap.  Empty spans hash to 0."""
    out = np.zeros(len(starts), dtype=np.uint64)
    length = ends - starts
    full = length > 0
    if not full.any():
        return out
    starts, length = starts[full], length[full]
    first = np.cumsum(length) - length
    at = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
    chars = raw[np.repeat(starts, length) + at]
    value = key[chars] * powers(int(length.max()))[at]
    out[full] = mix(np.add.reduceat(value, first) + length.astype(np.uint64))
    return out


@dataclass
class Spans:
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words(raw: np.ndarray, offsets: np.ndarray) -> Spans:
    """Maximal runs of other characters than SPACE, in each row."""
    n = len(raw)
    inside = ~SPACE[raw]
    begins, stops = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edge = offsets[(offsets > 0) & (offsets < n)]
        begins[edge] = inside[edge]
        stops[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Spans(np.searchsorted(offsets, start, "right") - 1, start, end)


def lines(raw: np.ndarray, offsets: np.ndarray) -> Spans:
    """The \\n-split lines of each row; an empty row has one empty line."""
    breaks = np.flatnonzero(raw == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    row_of_break = np.searchsorted(offsets, breaks, "right") - 1
    row = np.sort(np.concatenate([np.arange(len(offsets) - 1), row_of_break]), kind="stable")
    # a row's first line comes first: starts sort within rows as rows do not overlap
    order = np.lexsort((np.concatenate([offsets[:-1], breaks + 1]), np.concatenate([np.arange(len(offsets) - 1), row_of_break])))
    start = np.concatenate([offsets[:-1], breaks + 1])[order]
    last = np.append(row[1:] != row[:-1], True)
    end = np.where(last, offsets[row + 1], np.append(start[1:], 0) - 1)
    return Spans(row, start, end)


def windows(values: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive values of a row, and the index where each begins."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(row[:n] == row[width - 1 :])
    p = powers(width + 1)
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        total += values[at + k] * p[k + 1]
    return mix(total), at
