"""Stored state: bucketed merges, daily tables, mergeable counts and what a write sees."""

from __future__ import annotations

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from cohortloom.operators import distinct, lifecycle, tags
from cohortloom.session import scratch_path
from cohortloom.sources import buckets, sinks


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _state(spark, rows):
    return spark.createDataFrame(rows, "k int, id string, f int, l int")


def test_a_merge_shuffles_the_increment_alone(spark):
    rng = random.Random(2)
    # Key 0 holds a third; pairs are unique on a side.
    old = [(k, f"i{i}", i, i + rng.randrange(9)) for k, i in {(rng.choice([0, 0, 1, 2, 3]), rng.randrange(200)) for _ in range(400)}]
    new = [(k, f"i{i}", i + 3, i + 12) for k, i in {(rng.choice([0, 0, 2, 9]), rng.randrange(200)) for _ in range(150)}]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = buckets.store(_state(spark, old), ["k", "id"], 8)
        merge = lambda a, b: buckets.merged_state(a, b, ["k", "id"], "f", "l")
        merged = buckets.merge_stored(spark, table, _state(spark, new), ["k", "id"], merge)
        plan = _plan(merged)
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        again = buckets.store(merged, ["k", "id"], 8, in_place=True)
        assert spark.table(again).select(F.input_file_name()).distinct().count() == 8
        assert _plan(buckets.merge_stored(spark, again, _state(spark, new), ["k", "id"], merge)).count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = {}
    for k, i, f, last in old + new:
        a, b = expected.get((k, i), (f, last))
        expected[k, i] = (min(a, f), max(b, last))
    assert {(r.k, r.id): (r.f, r.l) for r in spark.table(again).collect()} == expected
    buckets.drop(spark, table)
    assert not spark.catalog.tableExists(table) and spark.catalog.tableExists(again)


def test_bucket_numbers_are_powers_of_two():
    assert [buckets.buckets_for(n) for n in (0, 1, 10**8, 10**9)] == [4, 4, 32, 256]


def test_tag_merge_on_buckets(spark):
    kind = "k int, tags map<string,string>, top string, day int"
    full = spark.createDataFrame([(1, {"a": "x"}, "p", 1), (2, {"a": "y"}, None, 2)], kind)
    new = spark.createDataFrame([(2, {"a": "z", "b": "w"}, "q", 3), (3, {"c": "v"}, None, 3)], kind)
    table = buckets.store(full, ["k"], 4)
    merged = buckets.merge_stored(spark, table, new, ["k"], lambda a, b: tags.merge_full_increment(a, b, "k", ["tags"], ["top"], "day"))
    assert sorted((r.k, tuple(sorted(r.tags.items())), r.top, r.day) for r in merged.collect()) == [
        (1, (("a", "x"),), "p", 1), (2, (("a", "z"), ("b", "w")), "q", 3), (3, (("c", "v"),), None, 3)
    ]


def test_health_reads_its_days_alone(spark):
    path, start = scratch_path(spark, "health"), date(2024, 1, 1)
    kind = "app string, new long, active long, silent long, lost long"
    days = [start + timedelta(days=i) for i in range(4)]
    rows = [[("a", 10 + i, 50, 5, 5), ("b", i, 5, 5, 2)][: 2 if i else 1] for i in range(4)]
    whole = None
    for day, part in zip(days, rows, strict=True):
        counts = spark.createDataFrame(part, kind)
        lifecycle.store_day(spark, path, counts, "app", day)
        dated = counts.withColumn("day", F.lit(day))
        whole = dated if whole is None else whole.unionByName(dated)
    lifecycle.store_day(spark, path, spark.createDataFrame(rows[3], kind), "app", days[3])  # a repeated run
    stored = lifecycle.stored_health(spark, path, "app", days[3])
    direct = lifecycle.health_score(lifecycle.growth_rates(whole, "app", "day"), "app", "day", days[3])
    assert sorted(tuple(r) for r in stored.collect()) == sorted(tuple(r) for r in direct.select(stored.columns).collect())
    plan = _plan(lifecycle._stored_days(spark, path, days[2], days[2]))
    assert "PartitionFilters: [isnotnull(day" in plan and "DataFilters: []" in plan


def test_distinct_counts_merge_over_days_and_keys(spark):
    rng = random.Random(5)
    rows = [(f"2024-01-0{rng.randrange(1, 8)}", rng.choice("aaab"), rng.randrange(3), rng.choice([7, rng.randrange(200_000)])) for _ in range(900)] + [("2024-01-03", "a", 1, None)]
    df = spark.createDataFrame(rows, "day string, app string, plat int, id long")
    states = distinct.day_state(df, ["day", "app", "plat"], "id")
    for keys in (["app"], ["app", "plat"], ["day"]):
        at = [("day", "app", "plat").index(k) for k in keys]
        expected = {}
        for r in rows:
            if r[3] is not None:
                expected.setdefault(tuple(r[i] for i in at), set()).add(r[3])
        found = distinct.counts(distinct.merged(states, keys), keys).collect()
        assert {tuple(r[k] for k in keys): r.cnt for r in found} == {k: len(v) for k, v in expected.items()}


def test_a_write_counts_as_it_goes(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(seen, "id long")
    assert sinks.write_sized(df, str(tmp_path / "sized"), 300) == 1000 and calls.value == 1000
    assert spark.read.parquet(str(tmp_path / "sized")).select(F.input_file_name()).distinct().count() == 3
    rows = spark.createDataFrame([("a",), (None,), ("b",), (None,), ("c",)], "line string")
    assert sinks.send(rows, lambda records: records.write.parquet(str(tmp_path / "topic"))) == {"ok": 3, "failed": 2}
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "topic")).collect()) == ["a", "b", "c"]


def test_reports_without_a_limit_are_ordered_parts(spark, tmp_path):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.report(df, str(tmp_path / "all"), [F.asc("x")])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(p for p in (tmp_path / "all").iterdir() if p.name.startswith("part-"))
    assert len(parts) > 1 and [int(line) for p in parts for line in p.read_text().split()[1:]] == list(range(500))
    sinks.report(df, str(tmp_path / "top"), [F.desc("x")], limit=3)
    assert [p.read_text().split() for p in (tmp_path / "top").iterdir() if p.name.startswith("part-")] == [["x", "499", "498", "497"]]
