"""Set expressions over named seed lists."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tagged_union(sets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(set name, key) of all inputs, duplicates kept."""
    parts = [df.select(F.lit(name).alias("set_name"), F.col(key)) for name, df in sets.items()]
    return reduce(DataFrame.unionAll, parts)


def set_expression(sets: Mapping[str, DataFrame], expression: str, key: str) -> DataFrame:
    """Distinct keys of ``"a | b - c"``: union, intersection (``&``) and difference with
    equal precedence, left to right, parentheses first.

    The expression becomes a condition on membership flags, so any number of operators
    costs one shuffle of pre-aggregated keys instead of one per operator.
    """
    condition = _membership_condition(expression, set(sets))
    used = [name for name in sets if name in set(re.findall(r"\w+", expression))]
    flags = [F.bool_or(F.col("set_name") == name).alias(f"in_{name}") for name in used]
    members = tagged_union({name: sets[name] for name in used}, key).groupBy(key).agg(*flags)
    return members.where(condition).select(key)


def _membership_condition(expression: str, names: set[str]) -> Column:
    combine = {
        "|": lambda a, b: a | b,
        "&": lambda a, b: a & b,
        "-": lambda a, b: a & ~b,
    }
    # One (value so far, pending operator) pair per open parenthesis.
    levels: list[list] = [[None, None]]

    def place(value: Column) -> None:
        left, pending = levels[-1]
        if (left is None) != (pending is None):
            raise ValueError(f"operator expected in {expression!r}")
        levels[-1] = [value if left is None else combine[pending](left, value), None]

    for token in re.findall(r"\w+|\S", expression):
        if token in combine:
            if levels[-1][0] is None or levels[-1][1] is not None:
                raise ValueError(f"misplaced {token!r} in {expression!r}")
            levels[-1][1] = token
        elif token == "(":
            levels.append([None, None])
        elif token == ")":
            value, pending = levels.pop()
            if value is None or pending is not None or not levels:
                raise ValueError(f"misplaced ')' in {expression!r}")
            place(value)
        elif token in names:
            place(F.col(f"in_{token}"))
        else:
            raise ValueError(f"unknown set {token!r}")
    if len(levels) != 1 or levels[0][0] is None or levels[0][1] is not None:
        raise ValueError(f"incomplete expression {expression!r}")
    return levels[0][0]


def set_counts(sets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows per input set plus a ``total`` row."""
    counts = tagged_union(sets, key).groupBy("set_name").agg(F.count("*").alias("cnt"))
    twice = counts.select(F.explode(F.array("set_name", F.lit("total"))).alias("set_name"), "cnt")
    return twice.groupBy("set_name").agg(F.sum("cnt").alias("cnt"))


def padded_union(*frames: DataFrame) -> DataFrame:
    """Union by name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_union(key: str, *frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionAll, [f.select(key) for f in frames]).distinct()
