"""State kept in bucketed tables, so that a daily merge shuffles the increment alone.

A version is a table of its own in the session's catalogue, its files below the shared folder: a failed or repeated merge never harms the one it reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import scratch_path

#: Rows that one bucket is meant to hold.
BUCKET_ROWS = 5_000_000


def buckets_for(rows: int) -> int:
    """A power of two, so that a later change of the number only splits or joins whole buckets."""
    return 1 << max(2, (max(1, rows // BUCKET_ROWS) - 1).bit_length())


def store(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "state", in_place: bool = False) -> str:
    """Writes ``df`` bucketed and sorted by ``keys`` and gives the table's name.

    The rows are dealt by the keys first, so that each bucket is one file. Those of a merge with a state of as many
    buckets lie right already and are written ``in_place``, without a shuffle.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df if in_place else df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", scratch_path(spark, name)).format("parquet").saveAsTable(table)
    return table


def merge_stored(spark: SparkSession, table: str, increment: DataFrame, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """``merge(full, increment)`` of a stored table and an increment. ``merge`` joins both on ``keys``, all of them: then
    only the increment is shuffled, to the table's buckets."""
    return merge(spark.table(table), increment)


def merged_state(full: DataFrame, increment: DataFrame, keys: Sequence[str], first: str, last: str) -> DataFrame:
    """First and last sights of both sides per key, as a full join of rows that are unique on either side."""
    old = full.select(*keys, F.col(first).alias("_f"), F.col(last).alias("_l"))
    both = old.join(increment.select(*keys, first, last), list(keys), "full")
    return both.select(*keys, F.least("_f", first).alias(first), F.greatest("_l", last).alias(last))


def drop(spark: SparkSession, table: str) -> None:
    """Forgets a version; its files stay until the shared folder is cleaned."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
