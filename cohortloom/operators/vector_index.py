"""An index for cosine search: inverted lists around centres, with an exact and a partial search.

The centres are fitted on a bounded sample; every vector is in the list of its nearest centre. A search compares a
vector with the lists of its ``probes`` nearest centres; with all lists it is exact. Long lists are cut into parts,
short ones are searched several to a task, so that a row is copied once for all its lists there. Lists that many
rows ask for deal these rows over tasks, so that a task holds a bounded number of either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import ranking
from cohortloom.operators.vectors import block_top, unit_vectors
from cohortloom.session import scratch_path

#: Vectors that the centres are fitted on: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
MOST_LISTS = 4096
#: Vectors of a list, and rows that ask for it, in one task.
PART_ROWS = 32_768
FIT_ROUNDS = 15


def fit_centres(sample: np.ndarray, lists: int) -> np.ndarray:
    """Unit centres of ``lists`` groups of unit vectors: spherical k-means from spread starts."""
    lists = min(lists, len(sample))
    centres = sample[:: max(1, len(sample) // lists)][:lists].copy()
    for _ in range(FIT_ROUNDS):
        own = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        # A centre without vectors stays where it is.
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


class VectorIndex:
    """``rows`` is a written table (id, unit, list, part); ``centres`` are broadcast (at most ``MOST_LISTS`` vectors)."""

    def __init__(self, df: DataFrame, key: str, vector: str, lists: int | None = None):
        """All vectors of ``df`` with a length above 0; keys are unique. By default the square root of their number of lists."""
        spark = self.spark = df.sparkSession
        units = unit_vectors(df, key, vector)
        self.n = units.count()
        lists = min(MOST_LISTS, lists or max(1, round(self.n**0.5)))
        sample = units.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).orderBy("id").toArrow()
        self.centres = fit_centres(_matrix(sample["unit"].combine_chunks()), lists) if self.n else np.zeros((0, 1))
        self.lists = len(self.centres)
        placed = self._nearest(units, 1).select("id", "unit", F.col("lists")[0].alias("list"))
        path = scratch_path(spark, "index")
        placed.write.parquet(path)
        stored = spark.read.parquet(path)
        sizes = stored.groupBy("list").agg(F.count(F.lit(1)).alias("_n"))
        #: (list, n, parts): at most ``MOST_LISTS`` rows.
        self.sizes = sizes.select("list", F.col("_n").alias("n"), F.ceil(F.col("_n") / PART_ROWS).cast("int").alias("parts"))
        self.rows = stored.join(F.broadcast(self.sizes.select("list", "parts")), "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def _nearest(self, units: DataFrame, probes: int) -> DataFrame:
        """(id, unit, lists): the numbers of the nearest centres, nearest first."""
        shared = self.spark.sparkContext.broadcast(self.centres)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres = shared.value
            for batch in batches:
                if batch.num_rows:
                    scores = np.round(_matrix(batch.column("unit")) @ centres.T, 9)
                    order = np.argsort(-scores, axis=1, kind="stable")[:, :probes].astype(np.int32)
                    flat = pa.FixedSizeListArray.from_arrays(pa.array(order.reshape(-1)), order.shape[1]).cast(pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("unit"), flat], ["id", "unit", "lists"])

        return units.mapInArrow(place, "id long, unit array<double>, lists array<int>")

    def _bundles(self) -> tuple[DataFrame, np.ndarray]:
        """(list, part, bundle): lists in bundles of at most ``PART_ROWS`` vectors, each part of a longer one by itself; and
        the first bundle and the number of parts by list."""
        sizes = sorted((r["list"], r["n"], r["parts"]) for r in self.sizes.collect())
        rows, of, bundle, held = [], np.zeros((self.lists, 2), dtype=np.int32), -1, PART_ROWS
        for number, n, parts in sizes:
            if parts > 1 or held + n > PART_ROWS:
                bundle, held = bundle + 1, 0
            of[number] = bundle, parts
            rows += [(number, part, bundle + part) for part in range(parts)]
            bundle, held = bundle + parts - 1, PART_ROWS if parts > 1 else held + n
        return self.spark.createDataFrame(rows, "list int, part int, bundle int"), of

    def search(self, queries: DataFrame, k: int, probes: int) -> DataFrame:
        """(id, other, score, rn): for each row of ``queries`` (id, unit) the ``k`` best others in its ``probes`` nearest lists."""
        bundles, of = self._bundles()
        if probes >= self.lists:
            # Every row meets every list: nothing to choose.
            asked = queries.select("id", "unit", F.lit(None).cast("array<int>").alias("lists")).join(F.broadcast(bundles.select("bundle").distinct()))
        else:
            shared = self.spark.sparkContext.broadcast(of)

            def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                """A row for each bundle with lists that are asked, with those."""
                for batch in batches:
                    lists = np.asarray(batch.column("lists").flatten())
                    row = np.repeat(np.arange(batch.num_rows), len(lists) // max(1, batch.num_rows))
                    first, parts = shared.value[lists].T
                    at = np.repeat(np.arange(len(lists)), parts)
                    bundle = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
                    order = np.lexsort((bundle, row[at]))
                    row, bundle, lists = row[at][order], bundle[order], lists[at][order]
                    starts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (bundle[1:] != bundle[:-1])]) if len(row) else row
                    held = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(lists)].astype(np.int32)), pa.array(lists))
                    own = batch.take(pa.array(row[starts]))
                    yield pa.RecordBatch.from_arrays([own.column("id"), own.column("unit"), held, pa.array(bundle[starts].astype(np.int32))], ["id", "unit", "lists", "bundle"])

            asked = self._nearest(queries, max(1, probes)).mapInArrow(ask, "id long, unit array<double>, lists array<int>, bundle int")
            path = scratch_path(self.spark, "asked")
            asked.write.parquet(path)
            asked = self.spark.read.parquet(path)
        demand = F.broadcast(asked.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("turns")))
        left = asked.join(demand, "bundle").withColumn("turn", F.pmod(F.xxhash64("id"), F.col("turns")).cast("int"))
        left = left.select(*[F.col(c).alias(c) for c in ("id", "unit", "lists", "bundle", "turn")])
        right = self.rows.join(F.broadcast(bundles), ["list", "part"]).join(demand, "bundle")
        right = right.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).select("id", "unit", "list", "bundle", "turn")

        def meet(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
            if own.empty or others.empty:
                return block_top(k, [])
            ids, x, partners, y = own["id"].to_numpy(), np.stack(own["unit"].to_numpy()), others["id"].to_numpy(), np.stack(others["unit"].to_numpy())
            if own["lists"].iloc[0] is None:
                return block_top(k, [(ids, x, partners, y)])
            lists, row = np.concatenate(own["lists"].to_numpy()), np.repeat(np.arange(len(own)), own["lists"].map(len))
            where = others["list"].to_numpy()
            found = block_top(k, [(ids[row[lists == n]], x[row[lists == n]], partners[where == n], y[where == n]) for n in np.unique(where)])
            found = found.sort_values(["id", "score", "other"], ascending=[True, False, True])
            return found[found.groupby("id").cumcount() < k]

        on = ["bundle", "turn"]
        partial = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(meet, "id long, other long, score double")
        return ranking.top_k_per_group(partial, ["id"], [F.desc("score"), F.asc("other")], k)

    def queries(self, every: int = 1) -> DataFrame:
        """The indexed vectors whose id ``every`` divides."""
        return self.rows.where(F.col("id") % every == 0).select("id", "unit")

    def list_ranks(self, k: int, every: int = 100) -> DataFrame:
        """(rank, n): how many of the true ``k`` best of every such row lie in its rank-th nearest list (1 is the nearest)."""
        asked = self.queries(every)
        exact = self.search(asked, k, self.lists).select("id", "other")
        order = self._nearest(asked, self.lists).select("id", "lists")
        where = self.rows.select(F.col("id").alias("other"), "list")
        ranked = exact.join(where, "other").join(order, "id").select(F.array_position("lists", F.col("list")).alias("rank"))
        return ranked.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))

    def probes_for(self, k: int, recall: float = 0.9, every: int = 100) -> int:
        """The fewest lists with which the rows that ``every`` divides find this share of their true ``k`` best."""
        counts = sorted((r["rank"], r["n"]) for r in self.list_ranks(k, every).collect())
        total, seen = sum(n for _, n in counts), 0
        for rank, n in counts:
            seen += n
            if seen >= recall * total:
                return int(rank)
        return max(1, self.lists)

    def recall(self, k: int, probes: int, every: int = 100) -> DataFrame:
        """One row (queries, pairs, found): the true best of the rows that ``every`` divides, and those the search finds."""
        asked = self.queries(every)
        exact = self.search(asked, k, self.lists).select("id", "other")
        found = self.search(asked, k, probes).select("id", "other").withColumn("hit", F.lit(1))
        both = exact.join(found, ["id", "other"], "left")
        return both.agg(F.count_distinct("id").alias("queries"), F.count(F.lit(1)).alias("pairs"), F.count("hit").alias("found"))
