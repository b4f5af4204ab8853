"""Word vectors (skip-gram with negative sampling) learned slice by slice, and their mean per row.

Rows are dealt over slices of a bounded number of words. A slice learns for itself, from first vectors that depend on the word and the
seed alone; a word's vector is the mean over its slices, weighted by its occurrences there, as in Spark ML's Word2Vec with one iteration.
A slice holds the vectors of its own words only, so neither the driver nor a task ever holds the vocabulary.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cohortloom.session import scratch_path

#: Known words in a slice, about.
SLICE_WORDS = 2_000_000
#: Words to either side at most; negative words of a batch and how many of them count for each pair.
WINDOW, NEGATIVES, WEIGHT = 5, 32, 5.0
#: Positions of a batch: blocks of consecutive ones.
BLOCKS, BLOCK = 32, 32
RATE = 0.05
#: Words whose vectors are added up at once.
SUMMED = 65_536


def first_vectors(hashes: np.ndarray, size: int) -> np.ndarray:
    """Uniform in +-1/2 over ``size``, a function of the word's hash (splitmix64 of hash and dimension)."""
    z = hashes.astype(np.uint64)[:, None] + np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / 2.0**53 - 0.5) / size).astype(np.float32)


def _step(table: np.ndarray, squares: np.ndarray, ids: np.ndarray, gradient: np.ndarray) -> None:
    """Adds each row's gradients, at a rate that falls with the sum of their squares."""
    order = np.argsort(ids, kind="stable")
    rows, starts = np.unique(ids[order], return_index=True)
    summed = np.add.reduceat(gradient[order], starts, axis=0)
    squares[rows] += np.einsum("ij,ij->i", summed, summed) / summed.shape[1]
    table[rows] += RATE * summed / np.sqrt(squares[rows] + 1e-12)[:, None]


def learn(ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, counts: np.ndarray, seed: list[int]) -> np.ndarray:
    """The vectors after one pass over the words ``ids``, of which those with equal ``rows`` are a text."""
    rng = np.random.default_rng(seed)
    context = np.zeros_like(vectors)
    squares, context_squares = np.zeros(len(vectors)), np.zeros(len(vectors))
    share = np.cumsum(counts.astype(np.float64) ** 0.75)
    batch = BLOCKS * BLOCK
    length = -(-len(ids) // batch) * batch
    # Beyond either end lies no text.
    padded = np.zeros(length + 2 * WINDOW, np.int64)
    padded[WINDOW : WINDOW + len(ids)] = ids
    texts = np.full(length + 2 * WINDOW, -1, np.int64)
    texts[WINDOW : WINDOW + len(ids)] = rows
    reach = rng.integers(1, WINDOW + 1, length)
    reach[len(ids) :] = 0
    apart = np.abs(np.arange(BLOCK)[:, None] + WINDOW - np.arange(BLOCK + 2 * WINDOW))
    around = np.arange(BLOCKS)[:, None] * BLOCK + np.arange(BLOCK + 2 * WINDOW)
    for start in range(0, length, batch):
        near = start + around
        words, others = padded[near[:, WINDOW:-WINDOW]], padded[near]
        pairs = (apart > 0) & (apart <= reach[start : start + batch].reshape(BLOCKS, BLOCK, 1))
        pairs &= texts[near[:, WINDOW:-WINDOW]][:, :, None] == texts[near][:, None, :]
        v, c = vectors[words], context[others]
        drawn = np.searchsorted(share, rng.random(NEGATIVES) * share[-1]).clip(max=len(share) - 1)
        n = context[drawn]
        # Pairs that occur are drawn together, the negative words are pushed off every word.
        pull = pairs / (1 + np.exp(np.matmul(v, c.transpose(0, 2, 1)).clip(-30, 30)))
        push = pairs.sum(2)[:, :, None] * (WEIGHT / NEGATIVES) / (1 + np.exp(-(v @ n.T).clip(-30, 30)))
        pull, push = pull.astype(np.float32), push.astype(np.float32)
        to_v = np.matmul(pull, c) - push @ n
        to_c = np.matmul(pull.transpose(0, 2, 1), v)
        to_n = -push.reshape(batch, -1).T @ v.reshape(batch, -1)
        _step(vectors, squares, words.ravel(), to_v.reshape(batch, -1))
        _step(context, context_squares, np.concatenate([others.ravel(), drawn]), np.concatenate([to_c.reshape(-1, c.shape[2]), to_n]))
    return vectors


def _words(texts: pa.Table, known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Per word of all texts its place in ``known`` (-1: unknown), and the number of words of each text."""
    lists = texts["tokens"].combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    places = pc.index_in(lists.flatten(), value_set=known["word"].combine_chunks())
    return pc.fill_null(places, -1).to_numpy(zero_copy_only=False).astype(np.int64), lengths


def _learner(size: int, seed: int):
    def learned(texts: pa.Table, known: pa.Table) -> pa.Table:
        # The order is the same wherever the slice is learned.
        texts, known = texts.sort_by("_order"), known.sort_by("word")
        vectors = first_vectors(known["_hash"].to_numpy(), size)
        if len(known):
            ids, lengths = _words(texts, known)
            rows = np.repeat(np.arange(len(lengths)), lengths)[ids >= 0]
            slice_seed = [seed & 0xFFFFFFFF, *(known["_slice"][0].as_py().to_bytes(4, "little"))]
            vectors = learn(ids[ids >= 0], rows, vectors, known["n"].to_numpy(), slice_seed)
        packed = pa.array([v.tobytes() for v in vectors], pa.binary())
        return pa.table({"_slice": known["_slice"], "word": known["word"], "_here": known["_here"], "vector": packed})

    return learned


def _mean_over_slices(rows: pd.DataFrame) -> pd.DataFrame:
    """Every slice of a word gets the word's mean."""
    rows = rows.sort_values(["word", "_slice"], ignore_index=True)
    vectors = np.frombuffer(b"".join(rows["vector"]), np.float32).reshape(len(rows), -1)
    weights = rows["_here"].to_numpy(np.float64)
    first = np.r_[True, rows["word"].to_numpy()[1:] != rows["word"].to_numpy()[:-1]]
    starts = np.flatnonzero(first)
    mean = np.add.reduceat(vectors * weights[:, None], starts, axis=0) / np.add.reduceat(weights, starts)[:, None]
    packed = [v.tobytes() for v in mean.astype(np.float32)]
    return rows[["_slice", "word"]].assign(vector=[packed[k] for k in np.cumsum(first) - 1])


def _embedder(size: int, schema_names: list[str]):
    def embedded(texts: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("word")
        vectors = np.frombuffer(b"".join(known["vector"].to_pylist()), np.float32).reshape(len(known), size)
        ids, lengths = _words(texts, known)
        means = np.zeros((len(lengths), size))
        for k, end in enumerate(np.cumsum(lengths)):
            of_text = ids[end - lengths[k] : end]
            of_text = of_text[of_text >= 0]
            for start in range(0, len(of_text), SUMMED):
                means[k] += vectors[of_text[start : start + SUMMED]].sum(axis=0, dtype=np.float64)
        # Like Spark ML: unknown words count in the length.
        means /= np.maximum(lengths, 1)[:, None]
        lists = pa.ListArray.from_arrays(np.arange(0, means.size + 1, size, dtype=np.int32), means.ravel())
        return texts.select(schema_names).append_column("embedding", lists)

    return embedded


def mean_vectors(worded: DataFrame, minimum_count: int, size: int, seed: int, slices: int) -> DataFrame:
    """``worded`` with ``embedding``, the mean vector of its ``tokens``: array<double>, zero without a known word."""
    spark, names = worded.sparkSession, list(worded.columns)

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    worded = stored(worded.withColumn("_order", F.xxhash64(*names)), "worded")
    total = worded.agg(F.sum(F.greatest(F.size("tokens"), F.lit(0)))).first()[0] or 0
    slices = max(slices, math.ceil(total / SLICE_WORDS))
    texts = worded.withColumn("_slice", F.pmod("_order", F.lit(slices)).cast("int"))
    here = stored(texts.select("_slice", F.explode("tokens").alias("word")).groupBy("_slice", "word").agg(F.count(F.lit(1)).alias("_here")), "slice_words")
    known = here.groupBy("word").agg(F.sum("_here").alias("n")).where(F.col("n") >= minimum_count)
    known = here.join(known, "word").withColumn("_hash", F.xxhash64("word", F.lit(seed)))
    learned = (
        texts.select("_slice", "_order", "tokens")
        .groupBy("_slice")
        .cogroup(known.groupBy("_slice"))
        .applyInArrow(_learner(size, seed), "_slice int, word string, _here long, vector binary")
    )
    # A bucket has a quarter of the rows of a slice.
    buckets = F.pmod(F.xxhash64("word"), F.lit(4 * slices))
    used = learned.groupBy(buckets.alias("_bucket")).applyInPandas(_mean_over_slices, "_slice int, word string, vector binary")
    schema = StructType([*worded.select(names).schema.fields, StructField("embedding", ArrayType(DoubleType()))])
    return texts.groupBy("_slice").cogroup(used.groupBy("_slice")).applyInArrow(_embedder(size, names), schema)
