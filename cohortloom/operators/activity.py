"""Activity bitmaps and the activity-in-an-interval audience filter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import bitmaps, dates

STATUSES = ("installed", "active", "uninstall", "new_install")

# Fixed status codes of the daily rows and the bitmaps each of them marks.
MARKS = {
    "uninstall": (-1,),
    "installed": (-1, 0, 1, 2),
    "new_install": (1,),
    "active": (3,),
}


def build_bitmaps(daily: DataFrame, entity: str, item: str, status: str, day: str, current: date) -> DataFrame:
    """One row per (entity, item) with a 13-slot bitmap per status from the daily rows of one year up to
    ``current``; a status never seen has no bitmap. All slots are one partial aggregate of integers."""
    start = date(current.year - 1, current.month, 1)
    rows = daily.where(F.col(day).between(F.lit(start), F.lit(current))).select(
        entity,
        item,
        F.col(status).alias("_s"),
        bitmaps.slot_of(F.col(day), current).alias("_slot"),
        bitmaps.day_bit(F.col(day)).alias("_bit"),
        F.col(day).alias("_day"),
    )
    # Parsed text: 52 small aggregates would otherwise cost hundreds of calls into the JVM.
    slots = [
        F.expr(f"bit_or(if(_s in {_codes(codes)} and _slot = {i}, _bit, null)) as {name}_{i}")
        for name, codes in MARKS.items()
        for i in range(bitmaps.SLOTS)
    ]
    wide = rows.groupBy(entity, item).agg(*slots, F.max("_day").alias("upper_time"))

    def assembled(name: str) -> Column:
        parts = [f"{name}_{i}" for i in range(bitmaps.SLOTS)]
        filled = ", ".join(f"coalesce({p}, 0)" for p in parts)
        return F.expr(f"if(coalesce({', '.join(parts)}) is not null, array({filled}), null) as {name}")

    return wide.select(entity, item, *[assembled(s) for s in STATUSES], "upper_time")


def _codes(codes: Sequence[int]) -> str:
    return "(" + ", ".join(str(c) for c in codes) + ")"


def add_day(state: DataFrame, today: DataFrame, entity: str, item: str, status: str, day: date) -> DataFrame:
    """Bitmaps after one more day of status rows. Bits are ORed, so running a day twice changes nothing.
    At the end of a month slot 0 moves to its calendar slot and rows last seen over a year ago go."""
    new = today.groupBy(entity, item).agg(
        *[
            F.when(
                F.bool_or(F.col(status).isin(*codes)), F.array(*[F.lit(1 << (day.day - 1) if i == 0 else 0) for i in range(bitmaps.SLOTS)])
            ).alias(f"_n_{name}")
            for name, codes in MARKS.items()
        ],
        F.lit(day).alias("_n_upper"),
    )
    merged = state.join(new, [entity, item], "full").select(
        entity,
        item,
        *[bitmaps.merge(F.col(s), F.col(f"_n_{s}")).alias(s) for s in STATUSES],
        F.greatest("upper_time", "_n_upper").alias("upper_time"),
    )
    tomorrow = date.fromordinal(day.toordinal() + 1)
    if tomorrow.month == day.month:
        return merged
    closed = [bitmaps.close_month(F.col(s), day.month).alias(s) for s in STATUSES]
    keep_from = F.add_months(F.lit(day), -12)
    return merged.where(F.col("upper_time") > keep_from).select(entity, item, *closed, "upper_time")


@dataclass(frozen=True)
class IntervalRule:
    """Keep (``include``) or drop entities by the number of listed items with ``status`` in the interval.

    ``restrict``: ``"0"`` at least one, ``"1"`` all listed items, ``"lo,hi"`` at least ``lo`` and fewer
    than ``hi``. Items compare without case. With ``include=False`` an entity stays when no listed item
    hits the interval. The interval is clipped to the days that the bitmaps hold; what lies outside hits nothing.
    """

    items: tuple[str, ...]
    status: str
    start: date
    end: date
    restrict: str = "0"
    include: bool = True

    def holds(self, hits: Column) -> Column:
        if not self.include:
            return hits == 0
        if self.restrict == "0":
            return hits >= 1
        if self.restrict == "1":
            return hits == len({i.lower() for i in self.items})
        low, high = (int(x) for x in self.restrict.split(","))
        return (hits >= low) & (hits < high)


def interval_hits(
    bitmaps_df: DataFrame, entity: str, item: str, rules: Sequence[IntervalRule], current: date
) -> DataFrame:
    """(entity, h0, h1, ...): listed items with a hit per rule, all rules in one pass."""
    name = F.lower(F.col(item).cast("string"))
    per_rule = []
    for rule in rules:
        masks = bitmaps.interval_masks(*dates.clamp_days(rule.start, rule.end, current), current)
        listed = name.isin(*{i.lower() for i in rule.items})
        per_rule.append(listed & bitmaps.hits(F.col(rule.status), masks))
    columns = [f"h{i}" for i in range(len(rules))]
    wanted = {i.lower() for rule in rules for i in rule.items}
    marked = bitmaps_df.where(name.isin(*wanted)).select(
        entity, name.alias("_item"), *[c.alias(h) for c, h in zip(per_rule, columns, strict=True)]
    )
    per_item = marked.groupBy(entity, "_item").agg(*[F.bool_or(h).alias(h) for h in columns])
    return per_item.groupBy(entity).agg(*[F.count_if(h).alias(h) for h in columns])


def activity_filter(
    seeds: DataFrame | None,
    bitmaps_df: DataFrame,
    entity: str,
    item: str,
    rules: Sequence[IntervalRule],
    current: date,
) -> DataFrame:
    """Seeds (every entity when ``None``) for which all rules hold; seed rows keep their multiplicity.
    Rules are ANDed on one row of hit counts per entity instead of one join per rule."""
    if seeds is None:
        seeds = bitmaps_df.select(entity).distinct()
    counts = interval_hits(bitmaps_df, entity, item, rules, current)
    kept = seeds.join(counts, entity, "left")
    for i, rule in enumerate(rules):
        kept = kept.where(rule.holds(F.coalesce(F.col(f"h{i}"), F.lit(0))))
    return kept.select(*seeds.columns)


def activity_filter_by_list(
    seeds: DataFrame,
    bitmaps_df: DataFrame,
    entity: str,
    item: str,
    list_column: str,
    separator: str,
    status: str,
    start: date,
    end: date,
    current: date,
    restrict: str = "0",
) -> DataFrame:
    """As :func:`activity_filter` with the item list of each seed row taken from a text column."""
    masks = bitmaps.interval_masks(*dates.clamp_days(start, end, current), current)
    hit = bitmaps_df.where(bitmaps.hits(F.col(status), masks)).select(
        entity, F.lower(F.col(item).cast("string")).alias("_item")
    ).distinct()
    lists = seeds.select(entity, list_column).distinct()
    wanted = F.array_distinct(F.split(F.lower(list_column), separator))
    cells = lists.select(entity, list_column, F.size(wanted).alias("_n"), F.explode(wanted).alias("_item"))
    joined = cells.join(hit.withColumn("_hit", F.lit(1)), [entity, "_item"], "left")
    counts = joined.groupBy(entity, list_column).agg(F.count("_hit").alias("_h"), F.max("_n").alias("_n"))
    if restrict == "0":
        ok = F.col("_h") >= 1
    elif restrict == "1":
        ok = F.col("_h") == F.col("_n")
    else:
        low, high = (int(x) for x in restrict.split(","))
        ok = (F.col("_h") >= low) & (F.col("_h") < high)
    return seeds.join(counts.where(ok).select(entity, list_column), [entity, list_column], "left_semi").select(*seeds.columns)


def satisfied_rules(results: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Keys present in all rule results: one union and count instead of n joins."""
    from functools import reduce

    marked = [r.select(*keys).distinct().withColumn("_rule", F.lit(i)) for i, r in enumerate(results)]
    both = reduce(DataFrame.unionAll, marked)
    return both.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") == len(results)).drop("_n")
