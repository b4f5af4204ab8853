"""Joins of a large table with a side of one row per key, where a key may hold a third of the large table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Rows of a side that may be broadcast; a larger one is copied per salt and joined by a shuffle.
BROADCAST_ROWS = 100_000
SALTS = 32


def join_per_key(df: DataFrame, side: DataFrame, on: list[str], rows: int | None = None) -> DataFrame:
    """Inner join with ``side``, which has one row per key ``on`` (no nulls) and ``rows`` rows (counted if not given).

    A counted small side is broadcast. For a larger one every key of ``df`` is dealt over ``SALTS`` tasks by a hash
    of the other columns, and each row of the side is copied to them, so that no key is one task.
    """
    if (side.count() if rows is None else rows) <= BROADCAST_ROWS:
        return df.join(F.broadcast(side), on)
    others = [F.col(c) for c in df.columns if c not in on]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int"))
    copied = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copied, [*on, "_salt"]).drop("_salt")
