"""Feature assembly, scaling, projection and vector similarity."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import ranking, word_vectors
from cohortloom.session import scratch_path


def _per_element(function: str, vector: str, dims: int) -> Column:
    """``array(function(v[0]), function(v[1]), ...)`` as one parsed expression."""
    return F.expr("array(" + ", ".join(f"{function}(cast(`{vector}`[{i}] as double))" for i in range(dims)) + ")")


def _literal(values: Sequence[float]) -> Column:
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def _dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def mean_vector(df: DataFrame, keys: Sequence[str], vector: str, dims: int, name: str = "mean") -> DataFrame:
    """True element-wise mean per key: one average per dimension, combined before the shuffle."""
    return df.groupBy(*keys).agg(_per_element("avg", vector, dims).alias(name))


def standardise(df: DataFrame, vector: str, dims: int, name: str = "scaled") -> DataFrame:
    """(x - mean) / sample standard deviation per dimension, 0 where the deviation is 0. The statistics are
    one row, used as a scalar subquery."""
    means, spreads = _per_element("avg", vector, dims), _per_element("stddev_samp", vector, dims)
    stats = df.agg(F.arrays_zip(means.alias("m"), spreads.alias("s"))).scalar()
    scaled = F.zip_with(
        F.col(vector),
        F.col("_stats"),
        lambda x, s: F.when(s["s"] > 0, (x.cast("double") - s["m"]) / s["s"]).otherwise(0.0),
    )
    return df.withColumn("_stats", stats).withColumn(name, scaled).drop("_stats")


def project(df: DataFrame, vector: str, loadings: Sequence[Sequence[float]], name: str = "projected") -> DataFrame:
    """Product with a given loading matrix (one row of weights per component), three decimals."""
    return df.withColumn(name, F.array(*[F.round(_dot(F.col(vector), _literal(row)), 3) for row in loadings]))


def rolling_store(
    history: DataFrame, today: DataFrame, key: str, day: str, newest, attributes: DataFrame, days: int = 60
) -> DataFrame:
    """Latest vector per entity of the last ``days`` days and today, with attributes."""
    recent = history.where(F.col(day) > F.date_sub(F.lit(newest), days))
    both = recent.unionByName(today)
    rest = [c for c in both.columns if c not in (key, day)]
    return ranking.latest_per_key(both, [key], [day, *rest]).join(attributes, key)


def lookalike(df: DataFrame, seeds: DataFrame, key: str, vector: str, dims: int, limit: int | None = None) -> DataFrame:
    """Entities by euclidean distance to the centroid of the seeds' vectors, nearest first, ties by key. The
    centroid is one row, used as a scalar subquery."""
    known = df.join(seeds.select(key).distinct(), key, "left_semi")
    centroid = known.agg(_per_element("avg", vector, dims)).scalar()
    gaps = F.zip_with(vector, F.col("_c"), lambda x, m: x.cast("double") - m)
    distance = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g))
    ranked = df.withColumn("_c", centroid).select(key, distance.alias("distance")).where(F.col("distance").isNotNull())
    return ranking.ordered_report(ranked, [F.asc("distance"), F.asc(key)], limit)


#: Rows and columns of a score matrix that a task holds at once.
SLICE_ROWS = 512
SLICE_COLUMNS = 8192


#: Vectors of a block of the all-pairs product; a task holds two blocks.
BLOCK_ROWS = 65_536


def _slice_top(k: int, own: np.ndarray, x: np.ndarray, partners: np.ndarray, y: np.ndarray, y32: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other, score) of the top ``k`` partners of each row of a slice of unit vectors.

    Scores in single precision tell which pairs may still be among the best; only those are measured in double.
    """
    x32 = x.astype(np.float32)
    # Twice what a single precision score may be off by, and the rounding.
    margin = 2 * (x.shape[1] + 4) * 2.0**-24 + 2e-6
    row, other, score = np.zeros(0, dtype=np.int64), partners[:0], np.zeros(0)
    floor = np.full(len(x), -np.inf)
    for at in range(0, len(partners), SLICE_COLUMNS):
        columns = slice(at, at + SLICE_COLUMNS)
        width = len(partners[columns])
        few = False
        if np.isfinite(floor).all():
            maybe = x32 @ y32[columns].T >= (floor - margin).astype(np.float32)[:, None]
            few = np.count_nonzero(maybe) * 32 <= maybe.size
        if few:
            near, column = np.divmod(np.flatnonzero(maybe), width)
            found = np.einsum("ij,ij->i", x[near], y[at + column])
        else:
            scores = x @ y[columns].T
            scores[own[:, None] == partners[None, columns]] = -np.inf
            scores[~np.isfinite(scores)] = -np.inf
            scores = np.round(scores, 6)
            # Everything at or above the k-th score of its row, ties included; only that is sorted.
            least = np.partition(scores, -min(k, width), axis=1)[:, -min(k, width)]
            near, column = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
            found = scores[near, column]
        # Six decimals before ranking, so that ties do not depend on the order of additions.
        row, other, score = np.r_[row, near], np.r_[other, partners[at + column]], np.r_[score, np.round(found, 6)]
        kept = (own[row] != other) & np.isfinite(score)
        row, other, score = row[kept], other[kept], score[kept]
        order = np.lexsort((other, -score, row))
        row, other, score = row[order], other[order], score[order]
        first = np.searchsorted(row, np.arange(len(x) + 1))
        kept = np.arange(len(row)) - first[row] < k
        full = np.diff(first) >= k
        floor[full] = score[first[:-1][full] + k - 1]
        row, other, score = row[kept], other[kept], score[kept]
    return row, other, score


def block_top(k: int, sides: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """(id, other, score): the top ``k`` partners of each left row, for (ids, matrix, other ids, other matrix) sides."""
    out = [pd.DataFrame({"id": pd.Series(dtype="int64"), "other": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})]
    for own, x, partners, y in sides:
        y32 = y.astype(np.float32)
        for at in range(0, len(own), SLICE_ROWS):
            rows = slice(at, at + SLICE_ROWS)
            row, other, score = _slice_top(k, own[rows], x[rows], partners, y, y32)
            out.append(pd.DataFrame({"id": own[rows][row], "other": other, "score": score}))
    return pd.concat(out[1:] or out)


def _block_pair(k: int):
    """Top-k partners inside one pair of blocks, in both directions, by matrix products."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return block_top(k, [])
        a, b = np.stack(left["unit"].to_numpy()), np.stack(right["unit"].to_numpy())
        ids, others = left["id"].to_numpy(), right["id"].to_numpy()
        sides = [(ids, a, others, b)]
        if left["block"].iloc[0] != right["block"].iloc[0]:
            sides.append((others, b, ids, a))
        return block_top(k, sides)

    return run


def unit_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, unit): vectors scaled to length 1; zero vectors drop."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(as_double, F.lit(0.0), lambda acc, x: acc + x * x))
    return df.select(F.col(key).alias("id"), as_double.alias("_v"), norm.alias("_n")).where("_n > 0").select(
        "id", F.transform("_v", lambda x: x / F.col("_n")).alias("unit")
    )


def cosine_top_k(df: DataFrame, key: str, vector: str, k: int = 30, side: int | None = None) -> DataFrame:
    """(id, other, score, rn): the exact ``k`` most similar others of every vector, self left out.

    Vectors are hashed into ``side`` blocks; each unordered pair of blocks meets in one task, which
    multiplies slices of the two matrices and hands on at most ``k`` partners per row in either
    direction, never the pairs themselves. The partial lists are cut again to ``k``. The work is
    quadratic, but spread evenly: blocks come from a hash of a unique id, so no group can be hot. Each
    vector is copied ``side`` times. By default a block has at most ``BLOCK_ROWS`` vectors, as a task holds two,
    and there are two pairs of blocks for each task slot of the cluster. ``vector_index`` has a search that is not quadratic.
    """
    units = unit_vectors(df, key, vector)
    slots = math.ceil(math.sqrt(4 * df.sparkSession.sparkContext.defaultParallelism))
    blocks = side or max(4, slots, math.ceil(df.count() / BLOCK_ROWS))
    placed = units.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    all_blocks = F.sequence(F.lit(0), F.lit(blocks - 1))
    left = placed.withColumn("pair", F.explode(F.filter(all_blocks, lambda b: b >= F.col("block"))))
    right = placed.withColumn("pair", F.explode(F.filter(all_blocks, lambda b: b <= F.col("block"))))
    left = left.select("id", "unit", "block", F.col("block").alias("i"), F.col("pair").alias("j"))
    right = right.select("id", "unit", "block", F.col("pair").alias("i"), F.col("block").alias("j"))
    partial = (
        left.groupBy("i", "j")
        .cogroup(right.groupBy("i", "j"))
        .applyInPandas(_block_pair(k), schema="id long, other long, score double")
    )
    return ranking.top_k_per_group(partial, ["id"], [F.desc("score"), F.asc("other")], k)


def fuse_scores(spaces: Sequence[DataFrame], keys: Sequence[str] = ("id", "other"), score: str = "score") -> DataFrame:
    """Harmonic mean of the non-zero scores a pair has over several spaces; 0 when it has none."""
    both = reduce(DataFrame.unionAll, [s.select(*keys, score) for s in spaces])
    present = F.col(score) != 0
    fused = F.count_if(present) / F.sum(F.when(present, 1 / F.col(score)))
    return both.groupBy(*keys).agg(F.coalesce(fused, F.lit(0.0)).alias(score))


def tokens(text: Column, stop_words: Sequence[str], pattern: str = r"[^\p{L}\p{N}]+") -> Column:
    """Lower-case words without stop words."""
    words = F.filter(F.split(F.lower(text), pattern), lambda w: w != "")
    return F.filter(words, lambda w: ~w.isin(list(stop_words)))


def latest_texts(df: DataFrame, name: str, text: str, day: str, newest, days: int = 180) -> DataFrame:
    """Latest text per name of the last ``days`` days."""
    recent = df.where(F.col(day) > F.date_sub(F.lit(newest), days)).select(name, text, day)
    return ranking.latest_per_key(recent, [name], [day, text])


def text_embedding(df: DataFrame, text: str, stop_words: Sequence[str], minimum_count: int, size: int = 100, seed: int = 42, slices: int = 8) -> DataFrame:
    """Mean Word2Vec vector of the tokens of each row, as array<double>, and the tokens. Words seen ``minimum_count`` times
    have a vector. The text is trained on in ``slices``, more when these would be large (``word_vectors``), so that the result
    does not depend on the cluster."""
    worded = df.withColumn("tokens", tokens(F.col(text), stop_words))
    return word_vectors.mean_vectors(worded, minimum_count, size, seed, slices)


def parse_vector(text: Column, separator: str = ",") -> Column:
    return F.transform(F.split(text, separator), lambda x: F.trim(x).try_cast("double"))


def named_vectors(
    vectors: DataFrame, key: str, counts: DataFrame, count: str, minimum: int, names: DataFrame
) -> DataFrame:
    """Vectors whose key is seen at least ``minimum`` times, with names (null without one)."""
    frequent = counts.where(F.col(count) >= minimum).select(key)
    return vectors.join(frequent, key, "left_semi").join(names, key, "left")


def category_counts(vectors: DataFrame, category: str) -> DataFrame:
    return vectors.groupBy(category).agg(F.count("*").alias("vectors"))


def one_hot_names(df: DataFrame, entity: str, columns: dict[str, Sequence[str] | None]) -> DataFrame:
    """(entity, space, feature, value): one row per attribute; values outside a given list become
    ``other``, a list of ``None`` keeps every value."""
    cells = []
    for name, kept in columns.items():
        value = F.col(name).cast("string")
        if kept is not None:
            value = F.when(value.isin(list(kept)), value).otherwise("other")
        cells.append(F.struct(F.lit(name).alias("space"), F.coalesce(value, F.lit("other")).alias("feature")))
    return df.select(entity, F.explode(F.array(*cells)).alias("c")).select(
        entity, "c.space", "c.feature", F.lit(1.0).alias("value")
    )


def sparse_features(long: DataFrame, entity: str) -> DataFrame:
    """(entity, indices csv, values csv) from (entity, space, feature, value) rows. Indexes follow each
    other space after space; inside a space the more frequent feature comes first, ties by name.

    The rows are reduced once to one per (entity, space, feature) with their number, in a written table;
    the dictionary is made from those numbers. An entity's features are bounded by the dictionary.
    """
    path = scratch_path(long.sparkSession, "features")
    long.groupBy(entity, "space", "feature").agg(F.sum("value").alias("value"), F.count("*").alias("_n")).write.parquet(path)
    cells = long.sparkSession.read.parquet(path)
    used = cells.groupBy("space", "feature").agg((-F.sum("_n")).alias("_rank"))
    dictionary = ranking.global_index(used, ["space", "_rank", "feature"], "index", start=0).drop("_rank")
    indexed = cells.join(dictionary, ["space", "feature"])
    parts = F.sort_array(F.collect_list(F.struct("index", "value")))
    return indexed.groupBy(entity).agg(
        F.transform(parts, lambda p: p["index"]).alias("indices"), F.transform(parts, lambda p: p["value"]).alias("values")
    )
