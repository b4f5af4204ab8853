"""Building and maintaining many-to-many entity mappings.

The stored state is long: one row (key, id, first_seen, last_seen) per pair, merged by union and
one associative aggregate, so it is never cut and no row grows with the data. Lists are a reader's
form: ``newest_ids`` cuts them to a number of ids that the caller names; who wants all ids of a key
reads the long rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.ranking import top_k_per_group


#: Pairs that a task merges at once, where the number of rows is known.
TASK_ROWS = 500_000


def _dealt(df: DataFrame, rows: int | None, *keys: str) -> DataFrame:
    """Rows by key, in as many partitions as ``rows`` need. Pairs rarely repeat within a task, so a merge before
    the shuffle would only hold the whole of a task's input."""
    return df if rows is None else df.repartition(max(1, -(-rows // TASK_ROWS)), *keys)


def first_last_seen(df: DataFrame, key: str, id_: str, first: str, last: str, rows: int | None = None) -> DataFrame:
    """State of (key, id) with the earliest ``first`` and the latest ``last``; rows without key or id drop. With ``rows``,
    their number at most, a task's memory does not grow with them."""
    known = _dealt(df.where(F.col(key).isNotNull() & F.col(id_).isNotNull()), rows, key, id_)
    return known.groupBy(key, F.col(id_).alias("id")).agg(
        F.min(first).alias("first_seen"), F.max(last).alias("last_seen")
    )


def newest_ids(state: DataFrame, key: str, limit: int) -> DataFrame:
    """``key, ids array<struct<last_seen, id, first_seen>>, update_time``: the ``limit`` ids seen last, ties
    by greater id. The cut happens before ids are collected; the newest id is never cut, so
    ``update_time`` is the overall maximum."""
    top = top_k_per_group(state, [key], [F.desc("last_seen"), F.desc("id")], limit, rank=None)
    return top.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("last_seen", "id", "first_seen")), asc=False).alias("ids"),
        F.max("last_seen").alias("update_time"),
    )


def explode_csv_ids(df: DataFrame, key: str, ids: str, first: str, last: str) -> DataFrame:
    """Aligned csv columns to rows (key, id, first_seen, last_seen); blank ids drop."""
    zipped = F.arrays_zip(
        F.split(ids, ",").alias("id"), F.split(first, ",").alias("first_seen"), F.split(last, ",").alias("last_seen")
    )
    return df.select(key, F.explode(zipped).alias("z")).select(key, "z.*").where(F.trim("id") != "")


def invert(df: DataFrame, entity: str, ids: str, first: str, last: str) -> DataFrame:
    """Entity -> ids table (aligned csv) turned into the state of id -> entities."""
    rows = explode_csv_ids(df, entity, ids, first, last).withColumnRenamed("id", "key")
    return first_last_seen(rows, "key", entity, "first_seen", "last_seen")


def merge_full_increment(full: DataFrame, increment: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """State after a day: pairs of either side, the same id in both keeps the earliest first and the
    latest last sight. Equal to one build over all rows, in whatever portions they come."""
    return _dealt(full.unionByName(increment), rows, key, "id").groupBy(key, "id").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )


def pair_expansion(df: DataFrame, left: str, right: str, time: str) -> DataFrame:
    """Every pair both ways, the earliest time per (owner, other)."""
    both = F.array(
        F.struct(F.col(left).alias("owner"), F.col(right).alias("other")),
        F.struct(F.col(right).alias("owner"), F.col(left).alias("other")),
    )
    rows = df.select(F.explode(both).alias("p"), F.col(time).alias("time"))
    return rows.groupBy("p.owner", "p.other").agg(F.min("time").alias("first_seen"))


def merge_pairs(history: DataFrame, pairs: DataFrame) -> DataFrame:
    """Stored and new (owner, other, first_seen): the earliest time per pair."""
    return history.unionByName(pairs).groupBy("owner", "other").agg(F.min("first_seen").alias("first_seen"))


def collected_pairs(pairs: DataFrame, limit: int) -> DataFrame:
    """Per owner the earliest ``limit`` others, ties by other."""
    top = top_k_per_group(pairs, ["owner"], [F.asc("first_seen"), F.asc("other")], limit, rank=None)
    return top.groupBy("owner").agg(F.sort_array(F.collect_list(F.struct("first_seen", "other"))).alias("others"))


def latest_elements(df: DataFrame, keys: Sequence[str], element: str, time: str, limit: int) -> DataFrame:
    """Distinct (element, time) per composite key, newest ``limit`` first, ties by greater element."""
    pairs = df.select(*keys, element, time).distinct()
    top = top_k_per_group(pairs, keys, [F.desc(time), F.desc(element)], limit, rank=None)
    return top.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(time, element)), asc=False).alias("elements"))


def recent_increment(state: DataFrame, key: str, since: Column) -> DataFrame:
    """(key, update_time) of the keys of a state seen on or after ``since``."""
    return state.groupBy(key).agg(F.max("last_seen").alias("update_time")).where(F.col("update_time") >= since)
