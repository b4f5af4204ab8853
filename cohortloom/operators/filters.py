"""Audience filters on attributes, tag maps and keys."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import maps

_COMPARE = {
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
    "!=": lambda a, b: a != b,
    "=": lambda a, b: a == b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
}


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _values(csv: str) -> list[str]:
    return [v.strip() for v in csv.split(",") if v.strip()]


def csv_overlaps(column: Column, wanted: Sequence[str]) -> Column:
    """Some element of the csv text is wanted; null text is false."""
    expected = F.array(*[F.lit(v) for v in wanted])
    return F.coalesce(F.arrays_overlap(F.split(column, ","), expected), F.lit(False))


def with_parents(codes: Column, width: int = 4) -> Column:
    """Category codes plus the ``width``-character parent of longer ones."""
    parents = F.transform(F.filter(codes, lambda c: F.length(c) > width), lambda c: F.substring(c, 1, width))
    return F.array_union(codes, parents)


def attribute_condition(
    conditions: Mapping[str, str], single_valued: Sequence[str], hierarchical: Sequence[str] = ()
) -> Column:
    """All non-blank conditions hold: membership for single-valued columns, csv overlap for
    list columns, with parents for hierarchical ones."""
    tests = []
    for name, csv in conditions.items():
        wanted = _values(csv)
        if not wanted:
            continue
        if name in single_valued:
            test = F.col(name).cast("string").isin(wanted)
        elif name in hierarchical:
            expected = F.array(*[F.lit(v) for v in wanted])
            test = F.arrays_overlap(with_parents(F.split(F.col(name), ",")), expected)
        else:
            test = csv_overlaps(F.col(name), wanted)
        tests.append(F.coalesce(test, F.lit(False)))
    return _all(tests)


def attribute_filter(
    df: DataFrame,
    include: Mapping[str, str],
    exclude: Mapping[str, str],
    single_valued: Sequence[str],
    hierarchical: Sequence[str] = (),
) -> DataFrame:
    """Every include must hold and no single exclude may hold."""
    keep = attribute_condition(include, single_valued, hierarchical)
    for name, csv in exclude.items():
        if _values(csv):
            keep = keep & ~attribute_condition({name: csv}, single_valued, hierarchical)
    return df.where(keep)


def geohash_prefix_match(stored: Sequence[Column], expected: Sequence[str]) -> Column:
    """Some expected hash starts with some stored hash of any csv list; blanks ignored."""
    empty = F.array().cast("array<string>")
    lists = [F.coalesce(F.split(c, ","), empty) for c in stored]
    hashes = F.filter(F.concat(*lists), lambda h: F.trim(h) != "")
    targets = [F.lit(e) for e in expected]
    return F.exists(
        hashes, lambda h: reduce(lambda a, b: a | b, [F.startswith(t, F.lower(h)) for t in targets])
    )


def map_tag_filter(
    df: DataFrame, include: Mapping[str, str], exclude: Mapping[str, str], tags: str = "tags"
) -> DataFrame:
    """``include``: the tag exists and its csv values meet the wanted ones. ``exclude``: a tag
    that exists must not meet them; a missing tag passes."""
    tests = [csv_overlaps(F.try_element_at(F.col(tags), F.lit(k)), _values(v)) for k, v in include.items()]
    tests += [~csv_overlaps(F.try_element_at(F.col(tags), F.lit(k)), _values(v)) for k, v in exclude.items()]
    return df.where(_all(tests))


def numeric_condition(value: Column, expression: str) -> Column:
    """``">=3 & <9"`` on a text value: at most two comparisons joined by ``|`` or ``&``. The empty
    expression asks for an empty value; a missing or non-numeric value fails."""
    text = expression.strip()
    if not text:
        return F.coalesce(value == "", F.lit(False))
    pieces = re.split(r"([|&])", text)
    if len(pieces) not in (1, 3):
        raise ValueError(f"at most two comparisons: {expression!r}")
    tests = []
    for piece in pieces[::2]:
        match = re.fullmatch(r"\s*(>=|<=|!=|=|>|<)\s*(-?[0-9.]+)\s*", piece)
        if not match:
            raise ValueError(f"not a comparison: {piece!r}")
        number = value.try_cast("double")
        tests.append(F.coalesce(_COMPARE[match[1]](number, F.lit(float(match[2]))), F.lit(False)))
    if len(tests) == 1:
        return tests[0]
    return tests[0] | tests[1] if pieces[1] == "|" else tests[0] & tests[1]


def list_filter(
    df: DataFrame, allowed: Mapping[str, Sequence], denied: Mapping[str, Sequence]
) -> DataFrame:
    """Chained IN and NOT IN; a blank list is no condition and NOT IN drops nulls."""
    tests = [F.col(c).isin(list(v)) for c, v in allowed.items() if v]
    tests += [~F.col(c).isin(list(v)) for c, v in denied.items() if v]
    return df.where(_all(tests))


def regex_clean(df: DataFrame, key: str, drop_letters: bool = False, drop_pattern: str | None = None) -> DataFrame:
    """Drop rows whose key has letters, or matches the pattern."""
    if drop_letters:
        df = df.where(~F.col(key).rlike("[A-Za-z]"))
    if drop_pattern:
        df = df.where(~F.col(key).rlike(drop_pattern))
    return df


def hash_sample(df: DataFrame, key: str, buckets: int, bucket: int) -> DataFrame:
    """Rows whose key falls into one of ``buckets`` stable hash buckets. The bucket comes from
    the leading 32 bits of md5, so other engines select the same keys."""
    number = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.where(F.pmod(number, F.lit(buckets)) == bucket)


def random_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


# Fixed list of labels that stand for "no information".
JUNK_LABELS = ("other", "-1", "unknown", "")


def drop_junk_shares(df: DataFrame, label: str, share: str) -> DataFrame:
    return df.where(~F.col(label).isin(*JUNK_LABELS) & F.col(share).isNotNull() & (F.col(share) > 0))


def drop_crowded_keys(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Drop keys with more than ``limit`` rows; counted before the join, so nothing is collected."""
    crowded = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > limit).select(key)
    return df.join(crowded, key, "left_anti")


def tag_equality(tags: Column, wanted: Mapping[str, str]) -> Column:
    return _all([F.try_element_at(tags, F.lit(k)) == v for k, v in wanted.items()])


def project_tags(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keep the requested keys of each map column; drop rows where the first one has none left."""
    for name in columns:
        df = df.withColumn(name, maps.project_keys(F.col(name), keys))
    return df.where(F.col(columns[0]).isNotNull())


def optimise_selection(
    seeds: DataFrame,
    activity: DataFrame,
    categories: DataFrame,
    key: str,
    item: str,
    level: str,
    wanted: Sequence[str],
) -> DataFrame:
    """Seeds active in the chosen items (``level`` = the item column) or category level;
    no choice keeps every seed. Seed rows keep their multiplicity."""
    if not wanted:
        return seeds
    if level == item:
        active = activity.where(F.col(item).isin(list(wanted)))
    else:
        chosen = categories.where(F.col(level).isin(list(wanted))).select(item)
        active = activity.join(chosen, item, "left_semi")
    return seeds.join(active.select(key).distinct(), key, "left_semi")


def report_threshold(df: DataFrame, minimums: Mapping[str, float]) -> DataFrame:
    return df.where(_all([F.col(c) > F.lit(v) for c, v in minimums.items()]))
