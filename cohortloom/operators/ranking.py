"""Latest row, top-k per group and global dense numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], oldest: bool = False) -> DataFrame:
    """One row per key: the greatest (or smallest) of ``order``.

    An aggregate instead of a window: every map task already reduces a hot key to one
    row, so no task ever sorts a whole group. ``order`` must end in a tie-break.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if oldest else F.max_by
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str | None = "rn",
    salts: int | None = None,
) -> DataFrame:
    """The first ``k`` rows of each group; ``order`` must be total within a group.

    Spark limits each map task to ``k`` rows per group before the shuffle
    (WindowGroupLimit), up to ``k`` = 1000. With ``salts`` > 1, the default for larger ``k``, a hot
    group is first cut to ``k`` rows in each of ``salts`` slices, so that the last task sees at most
    ``salts * k`` rows of it.
    """
    if salts is None:
        salts = 1 if k <= 1000 else 64
    if salts > 1:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c not in keys]), F.lit(salts))
        sliced = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", spread)
            .withColumn("_rn", F.row_number().over(sliced))
            .where(F.col("_rn") <= k)
            .drop("_rn", "_salt")
        )
    name = rank or "_rn"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.where(F.col(name) <= k)
    return out if rank else out.drop(name)


def global_index(df: DataFrame, order: Sequence[str], name: str = "index", start: int = 1) -> DataFrame:
    """Dense consecutive numbers over the whole frame in ``order`` (unique per row).

    A range sort numbers the rows inside each partition; partition sizes then become
    offsets. The sorted frame is checkpointed in between: both passes must see the same
    partitions, even after an executor is lost. The offsets are one row per partition; their
    running sum is the one window without a key.
    """
    from cohortloom.session import cut_lineage

    numbered = cut_lineage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.col("_offset") + within + start)
        .drop("_at", "_part", "_offset")
    )


def global_dense_rank(df: DataFrame, column: str, name: str = "rank") -> DataFrame:
    """Dense rank of ``column`` over the whole frame: number the distinct values, join back."""
    ranks = global_index(df.select(column).distinct(), [column], name)
    return df.join(ranks, column)


def rebased(df: DataFrame, column: str, name: str) -> DataFrame:
    """``column - min(column) + 1`` with the minimum as a scalar subquery."""
    lowest = df.agg(F.min(column)).scalar()
    return df.withColumn(name, F.col(column) - lowest + 1)


def ordered_report(df: DataFrame, order: Sequence[Column], limit: int | None = None) -> DataFrame:
    """Report order with an optional limit (TakeOrderedAndProject when limited)."""
    df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


def sorted_unique_partitions(df: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Range-partitioned, sorted rows with one row (smallest ``tie``) per key; the session's shuffle
    partitions say how many."""
    unique = latest_per_key(df, keys, tie, oldest=True)
    return unique.repartitionByRange(*keys).sortWithinPartitions(*keys)
