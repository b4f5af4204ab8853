from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import asof, lookup, mapping


def test_first_last_seen_with_limit(spark):
    rows = [("k", "d1", "20200101", "20200105"), ("k", "d2", "20200102", "20200109"), ("k", "d1", "20191201", "20200103"), ("k", "d3", "20200101", "20200109"), (None, "d4", "1", "2")]
    df = spark.createDataFrame(rows, "key string, id string, f string, l string")
    state = mapping.first_last_seen(df, "key", "id", "f", "l")
    row = mapping.newest_ids(state, "key", 2).first()
    assert [tuple(x) for x in row.ids] == [("20200109", "d3", "20200101"), ("20200109", "d2", "20200102")]
    full = mapping.newest_ids(state, "key", 9).collect()
    assert len(full) == 1 and tuple(full[0].ids[2]) == ("20200105", "d1", "20191201")
    assert full[0].update_time == "20200109"


def test_same_id_twice_in_one_csv(spark):
    df = spark.createDataFrame([("e1", "a,a,", "1,2,3", "5,4,6")], "entity string, x string, f string, l string")
    assert [tuple(r) for r in mapping.invert(df, "entity", "x", "f", "l").collect()] == [("a", "e1", "1", "5")]


def test_merge_equals_one_build_beyond_any_list(spark):
    rows = [("k", i, date(2010, 1, 1) + timedelta(days=i)) for i in range(300)] + [("k", 0, date(2020, 1, 1)), ("j", 1, date(2000, 1, 1))]
    schema = "key string, id int, day date"
    old, new = spark.createDataFrame(rows[:300], schema), spark.createDataFrame(rows[300:], schema)
    build = lambda df: mapping.first_last_seen(df, "key", "id", "day", "day")
    merged = mapping.merge_full_increment(build(old), build(new), "key")
    whole = build(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, merged.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    newest = mapping.newest_ids(merged.where("key = 'k'"), "key", 1).first()
    assert tuple(newest.ids[0]) == (date(2020, 1, 1), 0, date(2010, 1, 1))
    seeds = spark.createDataFrame([("k",), ("k",), ("none",)], "key string")
    assert lookup.match_rows(seeds, merged, "key").count() == 600


def test_merge_is_one_shuffle(spark):
    empty = spark.createDataFrame([], "key string, id int, first_seen date, last_seen date")
    plan = mapping.merge_full_increment(empty, empty, "key")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan


@pytest.mark.parametrize(("limit", "expected"), [(1, ["m3"]), (2, ["m3", "m2"]), (-1, ["m3", "m2", "m1"])])
def test_match_limits_and_unmatched_seeds(spark, limit, expected):
    ids = [("20200101", "m1"), ("20200201", "m2"), ("20200201", "m3")]
    table = spark.createDataFrame([("k1", ids)], "key string, ids array<struct<last_seen string, id string>>")
    seeds = spark.createDataFrame([("K1", 1), ("K1", 2), ("none", 3)], "key string, row int")
    matched = lookup.latest_matches(lookup.match(seeds, table, "key", F.lower("key")), {"ids": limit})
    rows = {r.row: r.ids for r in matched.collect()}
    assert [x.id for x in rows[1]] == expected and [x.id for x in rows[2]] == expected and rows[3] is None
    assert lookup.match(seeds, table, "key", F.lower("key"), keep_unmatched=False).count() == 2


def test_best_candidate_ties(spark):
    seeds = spark.createDataFrame([(1, [("t", "a"), ("t", "b")]), (2, None), (3, [("t", "c")]), (2, None)], "row int, ids array<struct<last_seen string, id string>>")
    weights = spark.createDataFrame([("a", 3), ("b", 3)], "id string, weight int")
    rows = sorted((r.row, r.best_id, r.best_weight) for r in lookup.best_candidate(seeds, "ids", weights, ["row"]).collect())
    assert rows == [(1, "b", 3), (2, None, None), (2, None, None), (3, "c", 0)]


def _brute(left, right, strict, forward, first_if_before):
    out = []
    for i, k, t in left:
        mine = [(rt, v) for rk, rt, v in right if rk == k]
        if forward:
            hits = [x for x in mine if (x[0] > t if strict else x[0] >= t)]
            at = min((x[0] for x in hits), default=None)
        else:
            hits = [x for x in mine if (x[0] < t if strict else x[0] <= t)]
            at = max((x[0] for x in hits), default=None)
            if at is None and first_if_before and mine:
                at, hits = min(x[0] for x in mine), mine
        out.append((i, None if at is None else max(v for rt, v in hits if rt == at)))
    return sorted(out)


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
@pytest.mark.parametrize(("strict", "forward", "first"), [(False, False, False), (True, False, False), (False, True, False), (True, True, False), (False, False, True), (True, False, True)])
def test_asof_against_brute_force(spark, kind, strict, forward, first):
    rng = random.Random(7)
    if kind == "date":
        when = lambda: date(2024, 1, 1) + timedelta(days=rng.randrange(40))
    else:
        when = lambda: datetime(2024, 1, 1) + timedelta(minutes=15 * rng.randrange(300))
    # Key 0 holds a third of either side; key 9 has no history.
    left = [(i, rng.choice([0, 0, 1, 2, 3, 9]), when()) for i in range(150)]
    right = [(rng.choice([0, 0, 1, 2, 3, 4]), when(), rng.randrange(5)) for _ in range(120)]
    ldf = spark.createDataFrame(left, f"i int, k int, t {kind}")
    rdf = spark.createDataFrame(right, f"k int, rt {kind}, v int").repartition(5)
    rows = asof.asof_join(ldf, rdf, ["k"], "t", "rt", ["v"], strict=strict, forward=forward, first_if_before=first, parts=7).collect()
    assert sorted((r.i, r.v) for r in rows) == _brute(left, right, strict, forward, first)


def test_asof_splits_a_hot_hour_and_a_hot_moment(spark):
    hour = datetime(2024, 1, 1, 12)
    left = [(i, 0, hour + timedelta(seconds=7 * i % 3600 if i % 2 else 0)) for i in range(600)] + [(1000 + i, i, hour) for i in range(300)]
    right = [(0, hour + timedelta(seconds=i), i % 13) for i in range(0, 3600, 5)]
    ldf, rdf = spark.createDataFrame(left, "i int, k int, t timestamp"), spark.createDataFrame(right, "k int, rt timestamp, v int")
    rows = asof.asof_join(ldf, rdf, ["k"], "t", "rt", ["v"], parts=16).collect()
    assert sorted((r.i, r.v) for r in rows) == _brute(left, right, False, False, False)
    placed = asof.ranged(ldf, [F.asc("k"), F.asc("t"), F.xxhash64("i")], 16)
    sizes = sorted(r["count"] for r in placed.groupBy("_part", "k").count().groupBy("_part").agg(F.max("count").alias("count")).collect())
    tasks = sorted(r["count"] for r in placed.groupBy("_part").count().collect())
    assert sizes[-1] <= tasks[-1] < 2.5 * tasks[len(tasks) // 2]


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("first", [False, True])
def test_asof_null_keys_and_times(spark, forward, first):
    if forward and first:
        return
    left = spark.createDataFrame([(1, None, date(2024, 1, 5)), (2, 1, None), (3, 1, date(2024, 1, 5)), (4, None, None)], "i int, k int, t date")
    right = spark.createDataFrame([(None, date(2024, 1, 5), 7), (1, None, 9), (1, date(2024, 1, 5), 5)], "k int, rt date, v int")
    rows = asof.asof_join(left, right, ["k"], "t", "rt", ["v"], forward=forward, first_if_before=first).collect()
    assert sorted((r.i, r.v) for r in rows) == [(1, None), (2, None), (3, 5), (4, None)]


def test_source_ignores_stays_without_start(spark):
    bounds = spark.createDataFrame([("d", date(2020, 1, 5), date(2020, 1, 5)), (None, date(2020, 1, 5), date(2020, 1, 5))], "device string, first_visit date, last_visit date")
    stays = spark.createDataFrame([("d", None, date(2020, 1, 9), "p1"), ("d", date(2020, 1, 2), None, "p2"), (None, date(2020, 1, 1), date(2020, 1, 8), "p3")], "device string, st date, en date, place string")
    frequent = spark.createDataFrame([("d", "home")], "device string, place string")
    rows = asof.source_and_flow(bounds, stays, frequent, "device", "st", "en", ["place"]).collect()
    assert sorted(((r.device or ""), r.source_place, r.flow_place) for r in rows) == [("", None, None), ("d", "p2", "p1")]


def test_asof_forms_no_pairs(spark):
    left = spark.createDataFrame([(1, date(2024, 1, 1))], "k int, t date")
    right = spark.createDataFrame([(1, date(2024, 1, 1), 5)], "k int, rt date, v int")
    plan = asof.asof_join(left, right, ["k"], "t", "rt", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_owner_preference_and_change_points(spark):
    rows = [("p", "202001", "a", 0, 9), ("p", "202001", "b", 1, 1), ("p", "202002", "b", 0, 2), ("p", "202002", "a", 0, 2), ("p", "202003", "b", 0, 1), ("p", "202004", "a", 0, 1)]
    df = spark.createDataFrame(rows, "pid string, tm string, device string, flag int, cnt int")
    points = asof.change_points(asof.owners_by_period(df, "pid", "device", "tm", "flag", "cnt"), "pid", "tm", "device")
    assert sorted((r.valid_from, r.device) for r in points.collect()) == [("202001", "b"), ("202004", "a")]


def test_flow_falls_back_to_the_frequent_place(spark):
    bounds = spark.createDataFrame([("d", "s", "2020-01-05 10", "2020-01-05 12")], "device string, store string, first_visit string, last_visit string")
    bounds = bounds.withColumn("first_visit", F.to_timestamp_ntz("first_visit", F.lit("yyyy-MM-dd HH"))).withColumn("last_visit", F.to_timestamp_ntz("last_visit", F.lit("yyyy-MM-dd HH")))
    stays = spark.createDataFrame([("d", datetime(2020, 1, 5, 8), datetime(2020, 1, 5, 9), "p1"), ("d", datetime(2020, 1, 5, 11), datetime(2020, 1, 5, 10), "p2")], "device string, st timestamp_ntz, en timestamp_ntz, place string")
    frequent = spark.createDataFrame([("d", "home")], "device string, place string")
    row = asof.source_and_flow(bounds, stays, frequent, "device", "st", "en", ["place"]).first()
    assert (row.source_place, row.flow_place) == ("p2", "home")


def test_parent_lookup_at_any_depth(spark):
    chain = [(i, i - 1 if i > 1 else None, i) for i in range(1, 12)]
    df = spark.createDataFrame([*chain, (50, 49, 7)], "id int, parent int, level int")
    rows = {r.id: r.ancestor for r in lookup.parent_at_level(df, "id", "parent", "level", 2).collect()}
    assert rows == {1: None, 50: None} | {i: 2 for i in range(2, 12)}


@pytest.mark.parametrize("length", [2, 3])
def test_parent_cycle_is_an_error(spark, length):
    df = spark.createDataFrame([(i, i % length + 1, 5) for i in range(1, length + 1)], "id int, parent int, level int")
    with pytest.raises(ValueError, match="cycle"):
        lookup.parent_at_level(df, "id", "parent", "level", 2)


def test_a_merge_is_dealt_by_its_rows(spark, monkeypatch):
    """As many tasks as the rows need, and the same state."""
    monkeypatch.setattr(mapping, "TASK_ROWS", 10)
    rows = spark.createDataFrame([(i % 7, i % 11, i) for i in range(200)] + [(None, 1, 1), (1, None, 1)], "k int, i int, d int")
    parts = [mapping.first_last_seen(rows.where(c), "k", "i", "d", "d", 202) for c in ("d < 90", "d >= 90")]
    merged = mapping.merge_full_increment(*parts, "k", 202)
    assert parts[0].rdd.getNumPartitions() == merged.rdd.getNumPartitions() == 21
    whole = mapping.first_last_seen(rows, "k", "i", "d", "d")
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect())) and merged.count() == 77
