"""Texts of an Arrow column as one byte array, so that numpy finds words, lines and windows.

Memory: a piece holds at most ``PIECE_BYTES`` of text, or one text if that alone is longer.
A null text counts as empty. Bytes from 0x80 on belong to characters outside ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true within the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


NOT_SPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


_held: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``size`` of them; kept for the longest piece so far."""
    if not _held or len(_held[0]) < size:
        _held.clear()
        for base in (_MULTIPLIER, _INVERSE):
            steps = np.full(size + size // 8, base, np.uint64)
            steps[0] = 1
            _held.append(np.cumprod(steps, out=steps))
    return _held[0], _held[1]


@dataclass
class Piece:
    """Some consecutive rows: ``first`` is the row of ``bounds[0]`` in its batch."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.bounds[row] : self.bounds[row + 1]].tobytes()

    def lowered(self) -> Piece:
        return Piece(self.first, LOWER[self.data], self.bounds)

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and rows of the maximal runs of flagged bytes; no run crosses a row."""
        flags = inside[self.data]
        before = np.empty_like(flags)
        before[:1], before[1:] = False, flags[:-1]
        inner = self.bounds[1:-1]
        first_bytes = inner[inner < len(flags)]
        before[first_bytes] = False
        after = np.empty_like(flags)
        after[-1:], after[:-1] = False, flags[1:]
        after[first_bytes[first_bytes > 0] - 1] = False
        starts = np.flatnonzero(flags & ~before)
        ends = np.flatnonzero(flags & ~after) + 1
        return starts, ends, np.searchsorted(self.bounds, starts, "right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges, from one running sum."""
        power, inverse = _powers(max(len(self.data), PIECE_BYTES) + 1)
        total = np.empty(len(self.data) + 1, np.uint64)
        total[0] = 0
        np.take(BYTE_VALUES, self.data, out=total[1:])
        total[1:] *= power[: len(self.data)]
        np.cumsum(total[1:], out=total[1:])
        return mix((total[ends] - total[starts]) * inverse[starts])

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Flagged bytes in each row."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """The rows of a string column in order, a bounded number of bytes at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    rows = len(column)
    if not rows:
        return
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    start = 0
    while start < rows:
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1)
        end = min(end, rows)
        yield Piece(start, data[bounds[start] : bounds[end]], bounds[start : end + 1] - bounds[start])
        start = end


def run_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the runs of ``size`` words that lie within one row."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    starts = np.flatnonzero(rows[:count] == rows[size - 1 :])
    total = np.zeros(len(starts), np.uint64)
    for step in range(size):
        total = total * np.uint64(_MULTIPLIER) + words[starts + step]
    return starts, mix(total + np.uint64(size))


def covered(starts: np.ndarray, size: int, count: int) -> np.ndarray:
    """Flags of the ``count`` words that lie in a run of ``size`` words from one of ``starts``."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, count), -1)
    return np.cumsum(change[:count]) > 0
