"""Best-fit packing of tokenised documents into sequences, by linear grouping.

Lengths are small integers, so a histogram of at most ``capacity`` counts describes all pieces and
the packing is planned on it: the large lengths (over a quarter of a sequence) are sorted and cut
into groups of equal cardinality, each rounded up to its largest length; a linear programme over
the configurations of these few sizes is solved; actual lengths take the places of the rounded
ones; what is left and the small pieces go by best fit into the gaps. The plan names, for each
length, which ranks of its pieces go where. Spark numbers the pieces of each length and looks their
places up, so no sequence is ever gathered.

Defined results: a null or empty text is the end id alone; a repeated row is packed each time; an
empty table gives an empty result; a document of over ``capacity`` ids is cut into pieces of which
only the first may be shorter; other columns are never read, so names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.numbering import number_within
from cohortloom.llm.textbytes import pieces
from cohortloom.llm.tokens import DEFAULT_FILE, encoder
from cohortloom.session import scratch_path

CAPACITY = 1024
END_ID = 2
GROUPS = 256
#: Large pieces are over this part of a sequence, so at most three share one.
LARGE_PART = 4


@dataclass
class Run:
    """``count`` equal sequences; ``items`` are (length, how many of it) in order."""

    count: int
    items: list[tuple[int, int]]
    room: int


def _configurations(sizes: list[int], capacity: int) -> np.ndarray:
    """All ways to put up to three of the sizes into a sequence; ``len(sizes)`` stands for no item."""
    n, width = len(sizes), np.array([*sizes, 0])
    a, b = np.triu_indices(n + 1)
    two = np.stack([a, b], 1)
    two = two[(width[two].sum(1) <= capacity) & (two[:, 0] < n)]
    three = []
    for c in range(n + 1):
        own = two[(two[:, 1] <= c) & (width[two].sum(1) + width[c] <= capacity)]
        three.append(np.column_stack([own, np.full(len(own), c)]))
    return np.concatenate(three).astype(np.int16)


def _solve(sizes: list[int], demand: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and how often, rounded down, of a least number of sequences that meet the demand."""
    n = len(sizes)
    ways = _configurations(sizes, capacity)
    basis = [tuple([i] * min(3, capacity // sizes[i])) for i in range(n)]

    def column(way) -> np.ndarray:
        return np.bincount([i for i in way if i < n], minlength=n).astype(float)

    matrix = np.stack([column(w) for w in basis], 1)
    for _ in range(40 * n):
        amounts = np.linalg.solve(matrix, demand.astype(float))
        price = np.append(np.linalg.solve(matrix.T, np.ones(n)), 0.0)
        gain = price[ways].sum(1)
        best = int(np.argmax(gain))
        if gain[best] <= 1 + 1e-9:
            break
        enters = column(ways[best])
        step = np.linalg.solve(matrix, enters)
        ratio = np.where(step > 1e-9, amounts / np.where(step > 1e-9, step, 1), np.inf)
        leaves = int(np.argmin(ratio))
        matrix[:, leaves] = enters
        basis[leaves] = tuple(int(i) for i in ways[best] if i < n)
    amounts = np.floor(np.linalg.solve(matrix, demand.astype(float)) + 1e-9).astype(int)
    left, out = demand.astype(int).copy(), []
    for way, amount in zip(basis, amounts.tolist(), strict=True):
        need = np.bincount(way, minlength=n)
        amount = min([amount, *(left[need > 0] // need[need > 0])])
        if amount > 0:
            left -= amount * need
            out.append((way, int(amount)))
    return out


def _take(segments: list[list[int]], amount: int) -> list[tuple[int, int]]:
    """The next ``amount`` pieces of a group as (length, count)."""
    out = []
    while amount:
        length, count = segments[0]
        own = min(count, amount)
        out.append((length, own))
        amount -= own
        segments[0][1] -= own
        if not segments[0][1]:
            segments.pop(0)
    return out


def _large_runs(large: list[tuple[int, int]], capacity: int, groups: int) -> tuple[list[Run], dict[int, int]]:
    """Runs for the large lengths, and the few pieces that rounding leaves."""
    total = sum(n for _, n in large)
    cut = np.linspace(0, total, min(groups, total) + 1).astype(int)
    queue, parts = [list(x) for x in large], []
    for size in np.diff(cut).tolist():
        if size:
            parts.append([list(x) for x in _take(queue, size)])
    merged: dict[int, list[list[int]]] = {}
    for part in parts:  # groups that round up to the same size are one
        merged.setdefault(part[0][0], []).extend(part)
    sizes = list(merged)
    supply = [merged[s] for s in sizes]
    demand = np.array([sum(n for _, n in part) for part in supply])
    runs = []
    for way, amount in _solve(sizes, demand, capacity):
        slots = [_take(supply[g], amount) for g in way]
        while amount:
            own = min(s[0][1] for s in slots)
            lengths = [s[0][0] for s in slots]
            runs.append(Run(own, [(x, 1) for x in lengths], capacity - sum(lengths)))
            amount -= own
            slots = [_less(s, own) for s in slots]
    left: dict[int, int] = {}
    for part in supply:
        for length, n in part:
            left[length] = left.get(length, 0) + n
    return runs, left


def _less(segments: list[tuple[int, int]], amount: int) -> list[tuple[int, int]]:
    length, count = segments[0]
    return [(length, count - amount), *segments[1:]] if count > amount else segments[1:]


def _best_fit(runs: list[Run], lengths: dict[int, int], capacity: int) -> list[Run]:
    """Best fit of the lengths, longest first, into the runs and new sequences."""
    by_room: list[list[Run]] = [[] for _ in range(capacity + 1)]
    for run in runs:
        by_room[run.room].append(run)
    for length in sorted(lengths, reverse=True):
        n, room = lengths[length], length
        while n:
            while room <= capacity and not by_room[room]:
                room += 1
            if room > capacity:
                each = capacity // length
                by_room[capacity].append(Run(-(-n // each), [], capacity))
                room = capacity
            run = by_room[room].pop()
            each = room // length
            full = min(run.count, n // each)
            put, bins = (each, full) if full else (n, 1)
            if run.count > bins:
                by_room[room].append(Run(run.count - bins, list(run.items), room))
            by_room[room - put * length].append(Run(bins, [*run.items, (length, put)], room - put * length))
            n -= put * bins
    return [run for own in by_room for run in own]


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs of equal sequences that hold every length of the histogram (length to count)."""
    lengths = {x: n for x, n in histogram.items() if n}
    whole = lengths.pop(capacity, 0)
    runs = [Run(whole, [(capacity, 1)], 0)] if whole else []
    large = sorted(((x, n) for x, n in lengths.items() if x * LARGE_PART > capacity), reverse=True)
    small = {x: n for x, n in lengths.items() if x * LARGE_PART <= capacity}
    if large:
        more, left = _large_runs(large, capacity, groups)
        return runs + _best_fit(more, small | left, capacity)
    return runs + _best_fit([], small, capacity)


def places(runs: list[Run]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, pieces per sequence, offset) of each run's items."""
    out, ranks, sequence = [], {}, 0
    for run in runs:
        offset = 0
        for length, each in run.items:
            first = ranks.get(length, 0)
            ranks[length] = first + run.count * each
            out.append((length, first, ranks[length], sequence, each, offset))
            offset += length * each
        sequence += run.count
    return out


def token_pieces(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = DEFAULT_FILE, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            names = batch.column("doc_id")
            for piece in pieces(batch.column("text")):
                row, out, raws = [], [], []
                for r, own in enumerate(encode.rows(piece)):
                    ids = np.append(own, end_id).astype("<u4")
                    end = len(ids) % capacity or capacity
                    start, part = 0, 0
                    while start < len(ids):
                        raw = ids[start:end].tobytes()
                        row.append(piece.first + r)
                        out.append((part, start, end - start, zlib.crc32(raw)))
                        raws.append(ids[start:end] if with_ids else None)
                        start, end, part = end, end + capacity, part + 1
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                columns[0] = columns[0].cast(pa.int32())
                fields = [names.take(pa.array(row)), *columns]
                if with_ids:
                    fields.append(pa.array([x.astype(np.int32) for x in raws], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(fields, ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])
        encode.clear()

    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def pack(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (``token_pieces``).

    The pieces are stored once in the shared folder; the histogram has at most ``capacity`` rows and
    the plan a few rows for each length, whatever the number of pieces.
    """
    spark = cut.sparkSession
    path = scratch_path(spark, "pieces")
    cut.write.parquet(path)
    stored = spark.read.parquet(path)
    histogram = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(places(plan_packing(histogram, capacity, groups)), "_length long, _first long, _after long, _sequence long, _each long, _offset long")
    ranked = number_within(stored, "length", ["doc_id", "piece", "ids_crc32"], "_rank", F.xxhash64("doc_id", "piece"), sum(histogram.values()))
    met = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_after"))
    at = F.col("_rank") - F.col("_first")
    return ranked.join(F.broadcast(plan), met).select(
        *stored.columns,
        (F.col("_sequence") + F.expr("(_rank - _first) div _each")).alias("sequence_id"),
        (F.col("_offset") + (at % F.col("_each")) * F.col("length")).cast("long").alias("offset"),
    )
