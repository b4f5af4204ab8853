"""Exact distinct counts that merge: bitmaps of whole-number entities, stored day by day.

The state of a day has one row per (keys, bucket) with the bitmap of the bucket's entities. A week or a month is the
union of its days' bitmaps: entities are never read again, and a merge shuffles bitmaps, not rows. Entities are
numbers from 0 on, dense ones (of a dictionary) best: a bucket spans 32 768 numbers in 4 KB, however few occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_state(df: DataFrame, keys: Sequence[str], entity: str) -> DataFrame:
    """(keys, bucket, bitmap) of the rows; null entities count nothing. A hot key is many buckets."""
    number = F.col(entity).cast("long")
    rows = df.where(number.isNotNull()).select(*keys, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("_at"))
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("_at").alias("bitmap"))


def merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of several days, or of coarser keys."""
    return states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counts(state: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """Distinct entities per keys of a state that is merged to those keys."""
    return state.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
