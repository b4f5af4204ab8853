"""As-of matching, change points and before/after joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.session import scratch_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ranged(df: DataFrame, order: Sequence[Column], parts: int | None = None, name: str = "ranged") -> DataFrame:
    """``df`` dealt over ranges of ``order`` and stored, with the range's number as ``_part``.

    Ranges hold about equally many rows whatever the keys are, and ranges of the same key follow each other.
    """
    dealt = df.repartitionByRange(*order) if parts is None else df.repartitionByRange(parts, *order)
    return _stored(dealt.withColumn("_part", F.spark_partition_id()), name)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    payload: Sequence[str],
    strict: bool = False,
    forward: bool = False,
    first_if_before: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Left rows with the ``payload`` of the last right row at or before (``strict``: before)
    their time; ``forward`` takes the first one at or after. Equal right times are settled by
    the greatest payload. ``first_if_before`` gives left rows older than the whole history the
    earliest right row instead of null. A right row with a null key or time answers nothing, a left
    row with one gets nulls; such rows take no part in the match.

    No pairs are formed. Both sides are dealt together over ranges of (key, time), so that a hot key, an
    hour of it, or a moment that many rows ask for, spreads over as many tasks as its rows need. Inside a
    range the last right row seen answers. Each range hands its last right row of a key on: these carry
    rows, one per (key, range), are chained along the key and begin the next range. ``parts`` is the number of
    ranges, by default the session's shuffle partitions.
    """
    if forward and first_if_before:
        raise ValueError("first_if_before goes with a backward match")
    kept = list(left.columns)

    def known(time: str) -> Column:
        out = F.col(time).isNotNull()
        for key in keys:
            out = out & F.col(key).isNotNull()
        return out

    # At equal times a right row comes before the asking row unless the match is strict.
    side_right, side_left = (1, 0) if strict else (0, 1)
    rows = right.where(known(right_time)).groupBy(*keys, F.col(right_time).alias("_t")).agg(F.max(F.struct(*payload)).alias("_p"))
    rows = rows.withColumn("_side", F.lit(side_right)).withColumn("_tie", F.lit(0).cast("long"))
    # The tie lets rows that ask at the same moment part; equal rows may answer for each other.
    tie = F.xxhash64(F.struct(*kept), F.monotonically_increasing_id())
    asks = left.where(known(left_time)).select(
        *keys, F.col(left_time).alias("_t"), F.struct(*kept).alias("_l"), F.lit(side_left).alias("_side"), tie.alias("_tie")
    )
    both = rows.unionByName(asks, allowMissingColumns=True)
    time = F.desc("_t") if forward else F.asc("_t")
    placed = ranged(both, [*[F.asc(k) for k in keys], time, F.asc("_side"), F.asc("_tie")], parts, "asof")

    # One row per (key, range): what the range hands on, and whether someone asks there.
    newest = F.min if forward else F.max
    answer = F.when(F.col("_p").isNotNull(), F.struct("_t", "_p"))
    chain = placed.groupBy(*keys, "_part").agg(
        newest(answer).alias("_end"), F.min(answer).alias("_start"), F.count("_l").alias("_asked")
    )
    along = Window.partitionBy(*keys).orderBy("_part")
    carried = F.last("_end", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    if first_if_before:
        carried = F.coalesce(carried, F.min("_start").over(Window.partitionBy(*keys)))
    chain = chain.withColumn("_carry", carried).where((F.col("_asked") > 0) & F.col("_carry").isNotNull())

    begun = placed.withColumn("_late", F.lit(1)).unionByName(
        chain.select(*keys, "_part", F.lit(0).alias("_late"), F.col("_carry._p").alias("_p")), allowMissingColumns=True
    )
    inside = Window.partitionBy(*keys, "_part").orderBy("_late", time, "_side")
    seen = F.last("_p", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    matched = begun.withColumn("_p", seen).where("_l is not null").select("_l.*", "_p.*")
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in payload]
    return matched.unionByName(left.where(~known(left_time)).select(*kept, *nothing))


def owners_by_period(df: DataFrame, key: str, owner: str, period: str, flag: str, count: str) -> DataFrame:
    """One owner per (key, period): flagged first, then highest count, then greatest owner."""
    return df.groupBy(key, period).agg(
        F.max(F.struct((F.col(flag) != 0).alias("f"), F.col(count), F.col(owner)))[owner].alias(owner)
    )


def change_points(df: DataFrame, key: str, period: str, owner: str) -> DataFrame:
    """(key, valid_from, owner) with consecutive repeats dropped. ``df`` has one row per
    (key, period), so a key's window is as long as the calendar."""
    previous = F.lag(owner).over(Window.partitionBy(key).orderBy(period))
    changed = df.withColumn("_prev", previous).where(~F.col(owner).eqNullSafe(F.col("_prev")))
    return changed.select(key, F.col(period).alias("valid_from"), owner)


def change_history(points: DataFrame, key: str, owner: str) -> DataFrame:
    """Change points as one ordered array per key."""
    entry = F.struct("valid_from", owner)
    return points.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("history"))


def latest_history(full: DataFrame, increment: DataFrame, key: str, updated: str) -> DataFrame:
    """Union of stored and new histories, the latest ``updated`` row per key."""
    from cohortloom.operators.ranking import latest_per_key

    rest = [c for c in full.columns if c not in (key, updated)]
    return latest_per_key(full.unionByName(increment), [key], [updated, *rest])


def visit_bounds(visits: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    return visits.groupBy(*keys).agg(F.min(time).alias("first_visit"), F.max(time).alias("last_visit"))


def source_and_flow(
    bounds: DataFrame,
    stays: DataFrame,
    frequent: DataFrame,
    entity: str,
    start: str,
    end: str,
    place: Sequence[str],
) -> DataFrame:
    """``bounds`` with ``source_*``: the last stay that starts strictly before the latest visit, and
    ``flow_*``: the first stay that ends strictly after the earliest visit, else the entity's frequent
    place. Stays at the same time are settled by the greatest place; a null time or entity never
    answers. ``bounds`` and ``frequent`` have one row per entity.

    The stays meet the bounds once and shrink in aggregates over (entity, end) and entity, which keep
    the join's partitioning.
    """
    kept = list(bounds.columns)
    met = bounds.join(stays.select(F.col(entity), F.col(start).alias("_st"), F.col(end).alias("_en"), F.struct(*place).alias("_p")), entity, "left")
    per_end = met.groupBy(*kept, "_en").agg(
        F.max(F.when(F.col("_st") < F.col("last_visit"), F.struct("_st", "_p"))).alias("_s"),
        F.max(F.when(F.col("_en") > F.col("first_visit"), F.col("_p"))).alias("_f"),
    )
    first_end = F.min(F.when(F.col("_f").isNotNull(), F.struct("_en", "_f")))
    found = per_end.groupBy(*kept).agg(F.max("_s").alias("_s"), first_end.alias("_f"))
    fallback = frequent.select(entity, F.struct(*place).alias("_often"))
    out = found.join(fallback, entity, "left")
    missing = F.col(f"_f._f.{place[0]}").isNull()
    return out.select(
        *kept,
        *[F.col(f"_s._p.{c}").alias(f"source_{c}") for c in place],
        *[F.when(missing, F.col(f"_often.{c}")).otherwise(F.col(f"_f._f.{c}")).alias(f"flow_{c}") for c in place],
    )


def visit_report(visits: DataFrame, profile: DataFrame, places: DataFrame, entity: str) -> DataFrame:
    """Visit rows with profile and source/flow columns. Both of these have one row per entity and are
    joined first, so that the visits, where an entity may be hot, are joined only once."""
    return visits.join(profile.join(places, entity), entity)


def point_in_time(
    requests: DataFrame,
    history: DataFrame,
    key: str,
    day: str,
    needed: Sequence[str],
    history_day: str,
    tag: str,
    value: str,
) -> DataFrame:
    """Per request (key, day): the latest value at or before the day of every needed tag, long
    form (request, tag, value day, value); the value is null for tags still missing."""
    tags = F.array(*[F.lit(t) for t in needed])
    asked = requests.select(key, day).distinct().withColumn(tag, F.explode(tags))
    known = history.where(F.col(tag).isin(list(needed))).select(
        key, tag, F.col(history_day).alias("value_day"), F.col(value).alias("value")
    )
    return asof_join(asked, known, [key, tag], day, "value_day", ["value_day", "value"])


def features_with_missing(pit: DataFrame, key: str, day: str, tag: str) -> DataFrame:
    """Long point-in-time rows to ``features`` map and sorted ``missing`` list per request."""
    entry = F.when(F.col("value").isNotNull(), F.struct(tag, "value"))
    lacking = F.when(F.col("value").isNull(), F.col(tag))
    return pit.groupBy(key, day).agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("features"),
        F.sort_array(F.collect_list(lacking)).alias("missing"),
    )


def daily_index(df: DataFrame, key: str, day: str, start: Column, end: Column, replacement: DataFrame) -> DataFrame:
    """Replace the rows of a day range by a newer version; all other days stay."""
    outside = df.where((F.col(day) < start) | (F.col(day) > end))
    inside = replacement.where((F.col(day) >= start) & (F.col(day) <= end))
    return outside.unionByName(inside)
