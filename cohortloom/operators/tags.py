"""The tag store: one map of tag values per entity.

Merges run in long form (key, tag, day, value) with partial aggregates; a map is collected last,
when each key has one row per tag, so its size is bounded by the tag catalogue.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import keys as K
from cohortloom.functions import maps


def unpivot_tags(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Wide source columns to (keys, tag, value) rows by a column -> tag table; blank values drop."""
    ids = [F.col(k) for k in keys]
    wide = df.select(*ids, *[F.col(c).cast("string").alias(t) for c, t in columns.items()])
    long = wide.unpivot(ids, [F.col(t) for t in columns.values()], "tag", "value")
    return long.where(~maps.is_blank(F.col("value")))


def window_tags(df: DataFrame, key: str, flag: str, window: str, feature: str, value: str) -> DataFrame:
    """Time-window rows to tags named ``feature_flag_window``."""
    tag = F.concat_ws("_", F.col(feature), F.col(flag).cast("string"), F.col(window).cast("string"))
    return df.select(key, tag.alias("tag"), F.col(value).cast("string").alias("value"))


def latest_wins(long: DataFrame, key: str, day: str = "day") -> DataFrame:
    """(key, tag, day, value) with the newest day per tag; equal days are settled by the greater value.
    Associative, so history and increments may be merged in any grouping."""
    newest = F.max(F.struct(F.col(day).alias("day"), F.col("value"))).alias("n")
    return long.groupBy(key, "tag").agg(newest).select(key, "tag", "n.day", "n.value")


def to_map(long: DataFrame, key: str, value: Column | None = None, name: str = "tags") -> DataFrame:
    """One map per key from rows that are unique per (key, tag)."""
    entry = F.struct(F.col("tag"), (F.col("value") if value is None else value).alias("value"))
    return long.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(name))


def to_timed_map(long: DataFrame, key: str, name: str = "tags") -> DataFrame:
    """``map<tag, struct(day, value)>``."""
    return to_map(long, key, F.struct("day", "value"), name)


def tag_rows(df: DataFrame, key: str, tags: str = "tags") -> DataFrame:
    """Map column back to (key, tag, value)."""
    return df.select(key, F.explode(tags).alias("tag", "value"))


def pairs_to_map(df: DataFrame, key: str, pairs: str, order: str) -> DataFrame:
    """Key-value text rows to one map per entity: blank values drop, the row with the greatest
    ``order`` wins a duplicate tag, ties by value."""
    rows = df.select(key, F.col(order).alias("day"), F.explode(maps.parse_pairs(F.col(pairs))).alias("p"))
    long = rows.select(key, "day", F.col("p.key").alias("tag"), F.col("p.value").alias("value"))
    return to_map(latest_wins(long, key), key)


def group_by_category(df: DataFrame, key: str, parents: DataFrame, tags: str = "tags") -> DataFrame:
    """(key, category, ids, values) with aligned csv texts in tag order. ``parents``: tag, category."""
    rows = tag_rows(df, key, tags).join(parents, "tag")
    parts = F.sort_array(F.collect_list(F.struct("tag", "value")))
    return rows.groupBy(key, "category").agg(
        F.array_join(F.transform(parts, lambda p: p["tag"]), ",").alias("ids"),
        F.array_join(F.transform(parts, lambda p: p["value"]), ",").alias("values"),
    )


def grouped_map(grouped: DataFrame, key: str) -> DataFrame:
    """``map<category, ids \\u0002 values>`` per key."""
    entry = F.struct("category", F.concat_ws(maps.KEY_SEPARATOR, "ids", "values").alias("value"))
    return grouped.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("grouped_tags"))


def merge_full_increment(
    full: DataFrame, increment: DataFrame, key: str, map_columns: Sequence[str], scalars: Sequence[str], updated: str
) -> DataFrame:
    """Stored and new tag rows (one per key each): new map entries and non-null scalars win, old ones
    stay; ``updated`` is the later of both."""
    old = full.select(key, *[F.col(c).alias(f"_o_{c}") for c in (*map_columns, *scalars, updated)])
    new = increment.select(key, *[F.col(c).alias(f"_n_{c}") for c in (*map_columns, *scalars, updated)])
    out = [maps.merge_maps(F.col(f"_o_{c}"), F.col(f"_n_{c}"), prefer="right").alias(c) for c in map_columns]
    out += [F.coalesce(f"_n_{c}", f"_o_{c}").alias(c) for c in scalars]
    out.append(F.greatest(f"_o_{updated}", f"_n_{updated}").alias(updated))
    return old.join(new, key, "full").select(key, *out)


def stamped_update(
    full: DataFrame, increment: DataFrame, key: str, day: Column, list_tags: Sequence[str], tags: str = "tags"
) -> DataFrame:
    """``full``: map<tag, struct(value, day)>; ``increment``: map<tag, value>. New entries get the day
    stamp. When the increment brings any list tag, all stored list tags go first."""
    old = full.select(key, F.col(tags).alias("_o"))
    new = increment.select(key, F.col(tags).alias("_n"))
    listed = list(list_tags)
    brings_list = F.exists(F.map_keys("_n"), lambda k: k.isin(listed))
    kept = F.when(
        F.coalesce(brings_list, F.lit(False)), F.map_filter("_o", lambda k, _: ~k.isin(listed))
    ).otherwise(F.col("_o"))
    stamped = F.transform_values("_n", lambda _, v: F.struct(v.alias("value"), day.alias("day")))
    return old.join(new, key, "full").select(key, maps.merge_maps(kept, stamped, prefer="right").alias(tags))


def assemble_profiles(sources: Sequence[DataFrame], key: str, updated: str) -> DataFrame:
    """Many entity-keyed sources in one row per entity: union and one aggregate instead of a tree of
    full joins. ``updated`` is the greatest non-blank time; other columns take their greatest non-blank
    value (each comes from one source)."""
    from cohortloom.operators.sets import padded_union

    both = padded_union(*sources)
    values = [c for c in both.columns if c not in (key, updated)]

    def filled(name: str) -> Column:
        if both.schema[name].dataType.typeName() == "string":
            return F.when(F.trim(name) != "", F.col(name))
        return F.col(name)

    return both.groupBy(key).agg(
        *[F.max(filled(c)).alias(c) for c in values], F.max(filled(updated)).alias(updated)
    )


def period_tags(long: DataFrame, key: str, day: str, period_ends: Mapping[str, Column], period: str) -> DataFrame:
    """Rows of each source period's last complete partition, merged latest-wins per entity."""
    due = reduce(
        lambda a, b: a | b, [(F.col(period) == p) & (F.col(day) == end) for p, end in period_ends.items()]
    )
    return latest_wins(long.where(due), key, day)


def label_relation_rows(increment: DataFrame) -> DataFrame:
    """Increment rows (value, type, label map, channel) to the resolved form: digest forms of the
    value by its type suffix, flag 1. Rows without labels drop."""
    kind = F.lower("type")
    is_md5 = F.endswith(kind, F.lit("md5"))
    is_sha = F.endswith(kind, F.lit("sha256"))
    plain = ~is_md5 & ~is_sha
    return increment.where(F.size("label") > 0).select(
        F.lit(1).alias("flag"),
        F.when(plain, F.col("value")).alias("plain"),
        F.when(plain, K.digest(F.col("value"), "md5")).when(is_md5, F.col("value")).alias("md5"),
        F.when(plain, K.digest(F.col("value"), "sha256")).when(is_sha, F.col("value")).alias("sha256"),
        F.array("type").alias("types"),
        "label",
        "channel",
    )


def resolve_entities(rows: DataFrame) -> DataFrame:
    """Merge rows that carry the same digest within a channel.

    ``rows``: flag (1 new, 2 stored), plain, md5, sha256, types, label map, channel. Pass 1 groups by
    md5 (rows that have one), pass 2 by sha256; rows known by md5 alone only take part in pass 1.
    Labels of the lower flag win. Two passes, not a transitive closure.
    """
    # Rows without the form of a pass go through it alone, so that either pass is one aggregate over all rows.
    alone = F.when(F.col("md5").isNull(), F.monotonically_increasing_id()).cast("string")
    by_md5 = _merge_by(rows.withColumn("_alone", alone), "md5")
    return _merge_by(by_md5.withColumn("_alone", F.when(F.col("sha256").isNull(), F.col("md5"))), "sha256")


def _merge_by(rows: DataFrame, form: str) -> DataFrame:
    keys = [form, "channel", "_alone"]
    others = [f for f in ("plain", "md5", "sha256") if f != form]
    # First one row per (digest, label), however many rows share the digest; then one row per digest.
    # Types and labels come from fixed lists, so what is collected is bounded.
    labelled = rows.select(*keys, "flag", *others, "types", F.explode_outer("label").alias("tag", "value"))
    per_label = labelled.groupBy(*keys, "tag").agg(
        F.min("flag").alias("flag"),
        *[F.max(f).alias(f) for f in others],
        F.array_distinct(F.flatten(F.collect_set("types"))).alias("types"),
        F.min(F.struct("flag", "value"))["value"].alias("value"),
    )
    entry = F.when(F.col("tag").isNotNull(), F.struct("tag", "value"))
    return (
        per_label.groupBy(*keys)
        .agg(
            F.min("flag").alias("flag"),
            *[F.max(f).alias(f) for f in others],
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("types")))).alias("types"),
            F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("label"),
        )
        .select("flag", "plain", "md5", "sha256", "types", "label", "channel")
    )


def split_by_category(df: DataFrame, key: str, categories: Mapping[str, Sequence[str]], tags: str = "tags") -> DataFrame:
    """(key, category, map) slices of a wide map; empty slices drop."""

    def part(name: str, wanted: Sequence[str]) -> Column:
        kept = F.map_filter(F.col(tags), lambda k, _: k.isin(list(wanted)))
        return F.struct(F.lit(name).alias("category"), kept.alias("tags"))

    cells = [part(name, wanted) for name, wanted in categories.items()]
    return df.select(key, F.explode(F.array(*cells)).alias("c")).select(key, "c.*").where(F.size("tags") > 0)
