"""Consistency and completeness reports, running sums and exact quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.distribution import with_totals
from cohortloom.operators.ranking import top_k_per_group
from cohortloom.session import cut_lineage


def normal_text(value: Column) -> Column:
    """Comparable form of a stored value: null equals empty, ``ids=values`` text in any order is equal."""
    sides = F.split(value, "=")
    pairs = F.zip_with(F.split(sides[0], ","), F.split(sides[1], ","), lambda a, b: F.concat_ws("=", a, b))
    grouped = F.contains(value, F.lit("=")) & (F.size(sides) == 2)
    return F.coalesce(F.when(grouped, F.array_join(F.sort_array(pairs), ",")).otherwise(value), F.lit(""))


def consistency(stored: DataFrame, served: DataFrame, key: str, sample: int) -> DataFrame:
    """Per tag: sampled entities, and how many have a different value in the served table. Both sides are
    (key, tag, value); the sample is the ``sample`` smallest hashes of non-blank stored values per tag."""
    filled = stored.where(F.trim("value") != "").withColumn("_h", F.md5(F.col(key).cast("string")))
    picked = top_k_per_group(filled, ["tag"], [F.asc("_h"), F.asc(key)], sample, rank=None)
    other = served.select(key, "tag", F.col("value").alias("_served"))
    same = normal_text(F.col("value")) == normal_text(F.col("_served"))
    joined = picked.join(other, [key, "tag"], "left")
    return joined.groupBy("tag").agg(
        F.count("*").alias("sampled"), F.count_if(~F.coalesce(same, F.lit(False))).alias("mismatched")
    )


def missing_partitions(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected (source, period) rows without a partition."""
    return expected.join(present.select(*keys).distinct(), list(keys), "left_anti")


def cumulative_counts(counts: DataFrame, order: Sequence[str], group: str, n: str) -> DataFrame:
    """(…, ``upto``): running sum of ``n`` in ``order`` (unique rows, led by ``group``) within each
    group, whatever its size: running sums inside sorted slices plus the total of earlier slices."""
    slices = cut_lineage(counts.orderBy(*order).withColumn("_part", F.spark_partition_id()))
    sizes = slices.groupBy(group, "_part").agg(F.sum(n).alias("_size"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        group, F.col("_part"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = slices.withColumn("_in", F.sum(n).over(inside))
    return running.join(offsets, [group, "_part"]).withColumn("upto", F.col("_offset") + F.col("_in")).drop(
        "_in", "_offset", "_part"
    )


def exact_quantiles(counts: DataFrame, group: str, value: str, n: str, levels: Sequence[float]) -> DataFrame:
    """(group, level, value): the smallest value whose cumulative count reaches ``level`` of the group.
    ``counts`` has one row per (group, value). Exact, and no task holds a whole group."""
    running = cumulative_counts(counts, [group, value], group, n)
    total = with_totals(running, [group], {"_total": n})
    # Six decimals, so that 0.95 * 20 asks for 19 and not 19.000000000000004.
    wanted = F.array(*[F.struct(F.lit(p).alias("level"), F.greatest(F.ceil(F.round(F.col("_total") * p, 6)), F.lit(1)).alias("at")) for p in levels])
    crossed = total.select(group, value, "upto", n, F.explode(wanted).alias("w")).where(
        (F.col("upto") >= F.col("w.at")) & (F.col("upto") - F.col(n) < F.col("w.at"))
    )
    return crossed.select(group, F.col("w.level").alias("level"), value)
