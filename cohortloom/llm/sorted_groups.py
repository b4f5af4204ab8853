"""Whole groups of sorted rows from a stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the groups of a sorted table begin, and its end; nulls are equal to each other."""
    turn = np.zeros(len(table), bool)
    turn[0] = True
    for key in keys:
        column = table[key].combine_chunks() if isinstance(table[key], pa.ChunkedArray) else table[key]
        one, two = column.slice(1), column.slice(0, len(column) - 1)
        same = pc.if_else(pc.and_(one.is_valid(), two.is_valid()), pc.equal(one, two), pc.equal(one.is_valid(), two.is_valid()))
        turn[1:] |= ~same.to_numpy(zero_copy_only=False).astype(bool)
    return np.append(np.flatnonzero(turn), len(table))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, of about ``rows`` rows or one group if that is larger, with ``group_starts``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        at = group_starts(table, keys)
        if len(at) > 2:
            yield table.slice(0, at[-2]).combine_chunks(), at[:-1]
            table = table.slice(at[-2])
        held = table.to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, group_starts(table, keys)
