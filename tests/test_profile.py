from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import profile


def _plain(values, numeric, ends):
    filled = [v for v in values if v is not None and str(v).strip(" ") != ""]
    out = {"blank_cnt": len(values) - len(filled), "valid_cnt": len(filled), "distinct_cnt": len(set(filled))}
    if not filled:
        return out
    if numeric:
        ordered = sorted(float(v) for v in filled)
        mean = math.fsum(ordered) / len(ordered)
        out |= {"mean": mean, "stddev": math.sqrt(math.fsum((v - mean) ** 2 for v in ordered) / len(ordered)), "min": ordered[0], "max": ordered[-1]}
        for p in profile.PROFILE_LEVELS:
            out[f"p{round(p * 100)}"] = ordered[max(math.ceil(round(len(ordered) * p, 6)), 1) - 1]
    else:
        counts = Counter(filled).items()
        for name, sign in (("top_values", -1), ("bottom_values", 1)):
            out[name] = ",".join(f"{v}:{n}" for v, n in sorted(counts, key=lambda x: (sign * x[1], x[0].encode()))[:ends])
    return out


@pytest.mark.parametrize("batch", [7, 10_000])
def test_profile_against_plain_counts(spark, batch):
    rng = random.Random(4)
    rows = [
        (
            rng.randrange(10**9, 10**9 + 40),
            None if rng.random() < 0.3 else rng.choice([rng.gauss(1e7, 1.0), -0.5, 12.0]),
            rng.choice(["é", "z", "", "  ", None, "hot", "hot", "hot", f"w{rng.randrange(60)}"]),
            None,
            f"t{i}",
        )
        for i in range(700)
    ]
    # Names of columns may be those the profile uses itself.
    names = ["value", "n", "col", "empty", "kind"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, "value long, n double, col string, empty double, kind string")
        found = {r["column_name"]: r.asDict() for r in profile.column_profile(df, 4).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [found[c]["column_index"] for c in names] == [1, 2, 3, 4, 5]
    for i, c in enumerate(names):
        wanted = _plain([r[i] for r in rows], i in (0, 1, 3), 4)
        for key in set(found[c]) - {"column_index", "column_name", "column_type"}:
            expected = wanted.get(key)
            assert found[c][key] == (pytest.approx(expected, rel=1e-8) if isinstance(expected, float) else expected), (c, key)


def test_profile_of_an_empty_table(spark):
    assert profile.column_profile(spark.createDataFrame([], "a int, b string")).collect() == []


def test_a_hot_value_and_one_shuffle_after_the_stored_slices(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("x"))
    report = profile.column_profile(df)
    row = report.first()
    assert (row["valid_cnt"], row["distinct_cnt"]) == (3000, 2000)
    values = sorted([5] * 1000 + [i for i in range(3000) if i % 3])
    assert row["p50"] == values[1499]
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
