"""Connected components of a graph by alternating stars, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.joins import BROADCAST_ROWS, SALTS
from cohortloom.session import scratch_path

MOST_ROUNDS = 60


def looked_up(df: DataFrame, side: DataFrame, on: str) -> DataFrame:
    """Left join with a stored side of one row per key, without a shuffle of ``df`` by a hot key."""
    if side.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(side), on, "left")
    others = [F.col(c) for c in df.columns if c != on]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int"))
    copied = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copied, [on, "_salt"], "left").drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (long columns a, b); the root is the smallest node.

    A round sends every node's neighbours to their smallest one, first those above the node and then
    those below it. Rounds are logarithmic in the longest path; each leaves at most as many edges as
    it found, in a written table. Loops and repeated edges are harmless; a null end drops the edge.

    The hub of a star is never the key of a shuffle of its edges: only nodes with edges on either side, or with several
    below, have anything to look up, one row each. Those rows are broadcast or, beyond a bound, copied per salt.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "stars")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    ends = edges.where("a is not null and b is not null and a <> b")
    now = written(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(now)
    for _ in range(MOST_ROUNDS if before[0] else 0):
        # Edges go from a to a smaller b. A node above is sent to the smallest neighbour of b: below b if b has edges down.
        lows = now.groupBy("a").agg(F.min("b").alias("low"))
        inner = written(lows.withColumnRenamed("a", "b").join(now.select("b").distinct(), "b"))
        moved = looked_up(now, inner, "b").select("a", F.coalesce("low", "b").alias("b"))
        large = written(moved.distinct())
        least = large.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n"))
        several = written(least.where("n > 1").select("a", "low"))
        small = looked_up(large, several, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = written(small.unionByName(least.select("a", F.col("low").alias("b"))).distinct())
        after = state(now)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
