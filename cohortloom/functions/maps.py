"""Map and array expressions shared by the mapping and tag operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed separators of the key-value text format.
PAIR_SEPARATOR = "\u0001"
KEY_SEPARATOR = "\u0002"


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def null_if_empty(mapping: Column) -> Column:
    return F.when(F.size(mapping) > 0, mapping)


def clean_map(mapping: Column) -> Column:
    """Drop blank values; an empty result is null."""
    return null_if_empty(F.map_filter(mapping, lambda _, v: ~is_blank(v)))


def project_keys(mapping: Column, keys: Sequence[str]) -> Column:
    """Only the requested keys; null when none is left."""
    return null_if_empty(F.map_filter(mapping, lambda k, _: k.isin(list(keys))))


def clean_confidence(confidence: Column, tags: Column) -> Column:
    """Confidence entries whose tag exists and is neither blank nor ``-1``."""
    kept = F.map_filter(
        confidence,
        lambda k, _: ~is_blank(F.try_element_at(tags, k)) & (F.try_element_at(tags, k) != "-1"),
    )
    return null_if_empty(kept)


def merge_maps(left: Column, right: Column, prefer: str) -> Column:
    """Union of two maps; on a shared key the ``prefer`` side (``left``/``right``) wins."""
    if prefer not in ("left", "right"):
        raise ValueError("prefer must be 'left' or 'right'")
    both = F.map_zip_with(
        left, right, lambda _, a, b: F.coalesce(a, b) if prefer == "left" else F.coalesce(b, a)
    )
    return F.coalesce(both, left, right)


def drop_empty_lists(mapping: Column) -> Column:
    return F.map_filter(mapping, lambda _, v: F.size(v) > 0)


def append_new(old: Column, new: Column) -> Column:
    """``old`` in order, then the elements of ``new`` it lacks; a null side counts as empty."""
    return F.coalesce(F.array_union(old, new), old, new)


def merge_keyed_lists(old: Column, new: Column) -> Column:
    """Per key, :func:`append_new` of both lists."""
    return F.map_zip_with(old, new, lambda _, a, b: append_new(a, b))


def latest(values: Column, times: Column, limit: int = 1) -> Column:
    """Values by (time desc, value desc); ``limit < 0`` keeps all."""
    pairs = F.zip_with(times, values, lambda t, v: F.struct(t.alias("t"), v.alias("v")))
    ordered = F.transform(F.sort_array(pairs, asc=False), lambda p: p["v"])
    return ordered if limit < 0 else F.slice(ordered, 1, limit)


def latest_ids(ids: Column, limit: int = 1) -> Column:
    """``ids`` is an array of structs led by (last_seen, id); the newest ``limit`` of them."""
    ordered = F.sort_array(ids, asc=False)
    return ordered if limit < 0 else F.slice(ordered, 1, limit)


def kept_times(values: Column, times: Column, keep) -> Column:
    """Aligned (value, time) pairs where ``keep(value)`` holds."""
    pairs = F.zip_with(values, times, lambda v, t: F.struct(v.alias("value"), t.alias("time")))
    return F.filter(pairs, lambda p: keep(p["value"]))


def parse_pairs(text: Column) -> Column:
    """Key-value text to array of (key, value), blank values dropped, order kept."""
    pieces = F.filter(F.split(text, PAIR_SEPARATOR), lambda p: F.contains(p, F.lit(KEY_SEPARATOR)))
    pairs = F.transform(
        pieces,
        lambda p: F.struct(
            F.substring_index(p, KEY_SEPARATOR, 1).alias("key"),
            F.substr(p, F.locate(KEY_SEPARATOR, p) + 1).alias("value"),
        ),
    )
    return F.filter(pairs, lambda p: ~is_blank(p["value"]))


def parse_sparse(text: Column) -> Column:
    """``"i,i=v,v"`` to array of (index, value); null when there is no ``=``."""
    sides = F.split(text, "=")
    pairs = F.zip_with(
        F.split(sides[0], ","),
        F.split(F.get(sides, F.lit(1)), ","),
        lambda i, v: F.struct(i.alias("index"), v.alias("value")),
    )
    return F.filter(pairs, lambda p: p["index"].isNotNull() & p["value"].isNotNull())
