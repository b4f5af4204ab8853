"""Increment-driven maintenance of stored state.

The batch merges are associative, so the same functions serve a daily run and a stream:
``foreachBatch`` hands every micro-batch to :func:`apply_increment`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def apply_increment(spark: SparkSession, base: str, version: int, increment: DataFrame, merge: Merge) -> str:
    """Merge an increment into state version ``version - 1`` and write ``version``; the first version is
    the increment itself. Versions are separate folders: a failed or repeated write never harms the
    state it reads, and running a version twice gives the same result."""
    target = f"{base}/v={version}"
    state = increment if version == 0 else merge(spark.read.parquet(f"{base}/v={version - 1}"), increment)
    state.write.mode("overwrite").parquet(target)
    return target


def maintain(stream: DataFrame, base: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame], merge: Merge):
    """Start a query that keeps versioned state up to date; ``prepare`` turns a micro-batch into an
    increment. Batch numbers are the versions, so a replayed batch rewrites its own folder."""

    def on_batch(batch: DataFrame, number: int) -> None:
        apply_increment(batch.sparkSession, base, number, prepare(batch), merge)

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
