"""Vectorised helpers for text inside Arrow tasks: words, lines and 64-bit hashes of byte spans.

A batch of texts is worked on in segments of about half a megabyte, so that the arrays of a segment
stay small whatever the batch holds. A text longer than that is a segment of its own.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SEGMENT_BYTES = 1 << 19

#: Space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(n, U(base))
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


@dataclass
class Segment:
    """Rows [first, last) of a batch; `data` holds their UTF-8 bytes, text i at offsets[i]:offsets[i + 1]."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first

    def text(self, i: int) -> str:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes().decode("utf-8", "replace")


def segments(column: pa.Array, limit: int = SEGMENT_BYTES) -> Iterator[Segment]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    column = column if wide or pa.types.is_string(column.type) else column.cast(pa.string())
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) if where else np.zeros(1, np.int64)
    data = np.frombuffer(what, np.uint8) if what else np.zeros(0, np.uint8)
    first, n = 0, len(column)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        own = offsets[first:last + 1]
        yield Segment(first, last, data[own[0]:own[-1]], own - own[0])
        first = last


def spans(seg: Segment, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the maximal runs of bytes that are no separators."""
    n = len(seg.data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    inside = ~separator[seg.data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = seg.offsets[:-1][seg.offsets[1:] > seg.offsets[:-1]]
    begin[filled] = inside[filled]
    edge = filled[1:] - 1
    end[edge] = inside[edge]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(seg.offsets, starts, "right") - 1


def words(seg: Segment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(seg, WHITE)


def lines(seg: Segment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (without the line feed) and row of the lines; an empty text is one empty line."""
    cuts = np.flatnonzero(seg.data == 10)
    starts = np.concatenate([seg.offsets[:-1], cuts + 1])
    row = np.concatenate([np.arange(seg.rows), np.searchsorted(seg.offsets, cuts, "right") - 1])
    ends = np.concatenate([cuts, seg.offsets[1:]])
    by_start, by_end = np.lexsort((starts, row)), np.lexsort((ends, np.concatenate([row[seg.rows:], np.arange(seg.rows)])))
    return starts[by_start], ends[by_end], row[by_start]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; equal bytes have equal hashes wherever they stand."""
    power, unpower = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * power[:len(data)], out=total[1:])
    own = (total[ends] - total[starts]) * unpower[starts]
    return mix(own + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def windows(hashes: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each run of `width` neighbouring words of one row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    own = np.zeros(n, U)
    for j in range(width):
        own = own * U(0xF1357AEA2E62A9C5) + hashes[j:n + j]
    at = np.flatnonzero(row[:n] == row[width - 1:])
    return mix(own[at]), at


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct hashes of its lower-cased word shingles.

    A row with fewer words has the whole sequence as its one shingle; a row without words has none.
    """
    for seg in segments(column):
        seg.data = LOWER[seg.data]
        starts, ends, row = words(seg)
        own = span_hashes(seg.data, starts, ends)
        hashes, at = windows(own, row, width)
        counts = np.bincount(row, minlength=seg.rows)
        first = np.concatenate([[0], np.cumsum(counts)])
        cut = np.searchsorted(row[at], np.arange(seg.rows + 1))
        for i in range(seg.rows):
            if counts[i] >= width:
                yield seg.first + i, np.unique(hashes[cut[i]:cut[i + 1]])
            elif counts[i]:
                short = np.array([counts[i]], U)
                for h in own[first[i]:first[i + 1]]:
                    short = mix(short + h)
                yield seg.first + i, short
            else:
                yield seg.first + i, np.zeros(0, U)


def per_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=rows).astype(np.int64)


def char_counts(data: np.ndarray) -> np.ndarray:
    """Number of code points before each byte, and in all."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
