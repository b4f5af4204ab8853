"""Column profiles: counts, moments, extremes, exact quantiles and frequent values of every column at once.

The table is scanned once and reduced to (column, value, count). These rows are sorted by ranges, and one pass over
the sorted slices gives per (slice, column) a summary: counts, moments, first and last number, most and least frequent
texts. The summaries, as many as slices and columns, tell in which slice a quantile lies and at which rank there, so
that no running sum over a whole column is needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage, scratch_path

# Fixed quantile levels of the profile report.
PROFILE_LEVELS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")

# A number and its rank within (slice, column), a summary of (slice, column), or one of its most or least frequent texts.
RANKED, SUMMARY, TOP, BOTTOM = "ranked", "summary", "top", "bottom"

SLICED = pa.schema(
    [("kind", pa.string()), ("slice", pa.int32()), ("col", pa.int32()), ("number", pa.float64()), ("value", pa.string()), ("n", pa.int64()), ("upto", pa.int64())]
    + [("blanks", pa.int64()), ("texts", pa.int64()), ("mean", pa.float64()), ("squares", pa.float64()), ("greatest", pa.float64())]
)
SLICED_DDL = (
    "kind string, slice int, col int, number double, value string, n long, upto long, blanks long, texts long, mean double, squares double, greatest double"
)


@dataclass
class Slice:
    """What is known of one column within one slice; its rows come in order of (number, value)."""

    part: int
    col: int
    ends: int
    blanks: int = 0
    valid: int = 0
    distinct: int = 0
    mean: float = 0.0
    squares: float = 0.0
    first: float | None = None
    last: float | None = None
    top: list[tuple[int, str]] = field(default_factory=list)
    bottom: list[tuple[int, str]] = field(default_factory=list)

    def add(self, numbers: pa.Array, values: pa.Array, n: np.ndarray, blank: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.blanks += int(n[blank].sum())
        n = n[~blank]
        if not len(n):
            return
        kept = pa.array(~blank)
        numbers, values = numbers.filter(kept), values.filter(kept)
        before, size = self.valid, int(n.sum())
        self.valid += size
        self.distinct += len(n)
        if numbers.null_count:
            self._add_texts(values, n)
            return
        x = numbers.to_numpy(zero_copy_only=False)
        mean = float((x * n).sum() / size)
        # Moments of two parts are joined around their means; sums of squares would lose small deviations.
        gap = mean - self.mean
        self.squares += float(((x - mean) ** 2 * n).sum()) + gap * gap * before * size / self.valid
        self.mean += gap * size / self.valid
        self.first = float(x[0]) if self.first is None else self.first
        self.last = float(x[-1])
        yield self._rows(RANKED, len(n), number=numbers, n=n, upto=before + np.cumsum(n))

    def _add_texts(self, values: pa.Array, n: np.ndarray) -> None:
        # Values ascend, so that a stable sort leaves ties in their order.
        for sign, name in ((-1, "top"), (1, "bottom")):
            picked = np.argsort(sign * n, kind="stable")[: self.ends]
            found = [(sign * int(n[i]), values[int(i)].as_py()) for i in picked]
            setattr(self, name, sorted(getattr(self, name) + found)[: self.ends])

    def summary(self) -> Iterator[pa.RecordBatch]:
        one = {"number": [self.first], "n": [self.valid], "upto": [self.distinct], "blanks": [self.blanks], "texts": [len(self.top)]}
        yield self._rows(SUMMARY, 1, **one, mean=[self.mean], squares=[self.squares], greatest=[self.last])
        for kind, found in ((TOP, self.top), (BOTTOM, self.bottom)):
            yield self._rows(kind, len(found), value=[v for _, v in found], n=[abs(n) for n, _ in found])

    def _rows(self, kind: str, count: int, **columns) -> pa.RecordBatch:
        columns |= {"kind": [kind] * count, "slice": [self.part] * count, "col": [self.col] * count}
        filled = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in SLICED]
        return pa.RecordBatch.from_arrays(filled, schema=SLICED)


def summarise(batches: Iterable[pa.RecordBatch], ends: int) -> Iterator[pa.RecordBatch]:
    """Ranks and summaries of one task's sorted rows (slice, col, number, value, n, blank). Holds one batch."""
    now = None
    for batch in batches:
        cols = batch.column("col").to_numpy()
        n = batch.column("n").to_numpy()
        blank = batch.column("blank").to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(np.diff(cols)) + 1).tolist()] if len(cols) else []
        for start, end in zip(starts, [*starts[1:], len(cols)], strict=True):
            if now is None or now.col != cols[start]:
                if now is not None:
                    yield from now.summary()
                now = Slice(batch.column("slice")[0].as_py(), int(cols[start]), ends)
            numbers, values = (batch.column(c).slice(start, end - start) for c in ("number", "value"))
            yield from now.add(numbers, values, n[start:end], blank[start:end])
    if now is not None:
        yield from now.summary()


def _whole_columns(slices: Sequence[Row], levels: Sequence[float]) -> tuple[list[tuple], list[tuple]]:
    """(col, mean, deviation) and (col, slice, level, rank in the slice) from the summaries of all slices."""
    moments, ranks = [], []
    of = {}
    for s in sorted(slices, key=lambda s: (s["col"], s["slice"])):
        if s["n"] and not s["texts"]:
            of.setdefault(s["col"], []).append(s)
    for col, parts in of.items():
        n = np.array([s["n"] for s in parts], dtype=float)
        means = np.array([s["mean"] for s in parts])
        mean = float((means * n).sum() / n.sum())
        squares = sum(s["squares"] for s in parts) + float(((means - mean) ** 2 * n).sum())
        moments.append((col, mean, math.sqrt(squares / n.sum())))
        upto = np.cumsum([s["n"] for s in parts])
        for level in levels:
            # Six decimals, so that 0.95 * 20 asks for 19 and not 19.000000000000004.
            at = max(math.ceil(round(int(upto[-1]) * level, 6)), 1)
            i = int(np.searchsorted(upto, at))
            ranks.append((col, parts[i]["slice"], level, at - int(upto[i]) + parts[i]["n"]))
    return moments, ranks


def column_profile(df: DataFrame, ends: int = 5, levels: Sequence[float] = PROFILE_LEVELS) -> DataFrame:
    """One row per column: position, name, type, blank, valid and distinct counts; for numbers mean,
    population deviation, min, max and exact quantiles (the smallest value whose cumulative count reaches the
    level); for text the ``ends`` most frequent values ("top") and least frequent ("bottom") as text, ties by value.

    Nulls and texts of blanks count as blank. A column without another value has counts alone; an empty table gives no
    rows. Three shuffles: distinct values, their order, and one row per column.
    """
    spark, types = df.sparkSession, dict(enumerate(kind for _, kind in df.dtypes))
    numeric = [i for i, kind in types.items() if kind in NUMERIC or kind.startswith("decimal")]
    texts = df.toDF(*map(str, types)).select([F.col(str(i)).cast("string").alias(str(i)) for i in types])
    counts = cut_lineage(texts.unpivot([], list(map(str, types)), "col", "value").groupBy("col", "value").agg(F.count("*").alias("n")))
    blank = F.col("value").isNull() | (F.trim("value") == "")
    number = F.when(F.col("col").isin([str(i) for i in numeric]), F.col("value").try_cast("double"))
    rows = counts.select(F.col("col").cast("int").alias("col"), number.alias("number"), "value", "n", blank.alias("blank"))
    in_order = rows.repartitionByRange("col", "number", "value").sortWithinPartitions("col", "number", "value")
    path = scratch_path(spark, "profile")
    in_order.withColumn("slice", F.spark_partition_id()).mapInArrow(lambda batches: summarise(batches, ends), SLICED_DDL).write.parquet(path)
    sliced = spark.read.parquet(path)

    # As many summaries as slices and columns together.
    moments, ranks = _whole_columns(sliced.where(F.col("kind") == SUMMARY).select("col", "slice", "n", "texts", "mean", "squares").collect(), levels)
    # One row per level and column.
    wanted = spark.createDataFrame(ranks, "col int, slice int, level double, at long").withColumn("kind", F.lit(RANKED))
    crossed = (F.col("upto") >= F.col("at")) & (F.col("upto") - F.col("n") < F.col("at"))
    found = sliced.join(F.broadcast(wanted), ["col", "slice", "kind"], "left").where((F.col("kind") != RANKED) | crossed)

    def summed(name):
        return F.sum(F.when(F.col("kind") == SUMMARY, F.col(name)))

    def listed(kind, sign):
        entries = F.collect_list(F.when(F.col("kind") == kind, F.struct((F.col("n") * sign).alias("order"), "value", "n")))
        picked = F.slice(F.sort_array(entries), 1, ends)
        return F.when(F.size(picked) > 0, F.array_join(F.transform(picked, lambda p: F.concat_ws(":", p["value"], p["n"].cast("string"))), ","))

    per_column = found.groupBy("col").agg(
        summed("blanks").alias("blank_cnt"),
        summed("n").alias("valid_cnt"),
        summed("upto").alias("distinct_cnt"),
        F.min(F.when(F.col("kind") == SUMMARY, F.col("number"))).alias("min"),
        F.max(F.when(F.col("kind") == SUMMARY, F.col("greatest"))).alias("max"),
        *[F.max(F.when(F.col("level") == p, F.col("number"))).alias(f"p{round(p * 100)}") for p in levels],
        listed(TOP, -1).alias("top_values"),
        listed(BOTTOM, 1).alias("bottom_values"),
    )
    names = spark.createDataFrame([(i, name, types[i]) for i, name in enumerate(df.columns)], "col int, column_name string, column_type string")
    spread = spark.createDataFrame(moments, "col int, mean double, stddev double")
    columns = F.broadcast(names.join(F.broadcast(spread), "col", "left"))
    quantiles = [f"p{round(p * 100)}" for p in levels]
    head = [(F.col("col") + 1).alias("column_index"), "column_name", "column_type", "blank_cnt", "valid_cnt", "distinct_cnt"]
    return per_column.join(columns, "col").select(*head, "mean", "min", "max", "stddev", *quantiles, "top_values", "bottom_values")
