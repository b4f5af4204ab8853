"""Gapless numbers within a key, without collecting a key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows that one window partition is meant to hold.
ROWS_PER_SALT = 1_000_000
LEAST_SALTS = 16


def number_within(df: DataFrame, key: str, order: list[str], into: str, salt_of: Column, rows: int) -> DataFrame:
    """Adds ``into``: 0, 1, ... within each ``key``, in the order of (salt, ``order``).

    Each key is dealt over salts, each salt is numbered for itself, and the salts' row counts give
    where its numbers begin. ``df`` is read twice, so it should be a stored table.
    """
    salts = max(LEAST_SALTS, -(-rows // ROWS_PER_SALT))
    salted = df.withColumn("_salt", F.pmod(salt_of, F.lit(salts)).cast("int"))
    counts = salted.groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(key).alias("_key"), F.col("_salt").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(key, "_salt").orderBy(*order)
    numbered = salted.withColumn("_at", F.row_number().over(within) - 1)
    joined = numbered.join(starts, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_of")))
    return joined.withColumn(into, (F.col("_start") + F.col("_at")).cast("long")).drop("_salt", "_n", "_at", "_start", "_key", "_of")
