from __future__ import annotations

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import bitmaps, dates
from cohortloom.operators import activity, distribution, lifecycle, tags
from cohortloom.operators.activity import IntervalRule

CURRENT = date(2020, 11, 30)


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_latest_wins_is_order_free(spark):
    rows = [("d", "a", "20200101", "1"), ("d", "a", "20200301", "3"), ("d", "a", "20200201", "2"), ("d", "b", "20200101", "x"), ("d", "b", "20200101", "y")]
    df = spark.createDataFrame(rows, "k string, tag string, day string, value string")
    for parts in (1, 3, 5):
        merged = tags.to_map(tags.latest_wins(df.repartition(parts), "k"), "k").first().tags
        assert merged == {"a": "3", "b": "y"}


def test_increment_wins_in_tags_and_confidence(spark):
    schema = "k string, tags map<string,string>, confidence map<string,string>, catelist string, update_time string"
    full = spark.createDataFrame([("a", {"t": "old", "u": "1"}, None, "c0", "20200101"), ("b", {"t": "1"}, None, None, "20200101")], schema)
    new = spark.createDataFrame([("a", {"t": "new"}, {"t": "0.9"}, None, "20200102"), ("c", {"t": "2"}, None, "c1", "20200102")], schema)
    rows = {r.k: r for r in tags.merge_full_increment(full, new, "k", ["tags", "confidence"], ["catelist"], "update_time").collect()}
    assert rows["a"].tags == {"t": "new", "u": "1"} and rows["a"].confidence == {"t": "0.9"}
    assert rows["a"].catelist == "c0" and rows["a"].update_time == "20200102" and set(rows) == {"a", "b", "c"}


def test_entity_resolution_two_passes(spark):
    rows = [
        ("p1", "phone", {"1": "plain"}, "ch"),
        (md5("p1"), "phonemd5", {"1": "md5", "2": "m"}, "ch"),
        (sha("p1"), "phonesha256", {"3": "s"}, "ch"),
        (md5("p2"), "phonemd5", {"1": "only"}, "ch"),
        (sha("p3"), "phonesha256", {"1": "only"}, "ch"),
        ("p1", "phone", {"1": "other"}, "ch2"),
        ("p4", "phone", {}, "ch"),
    ]
    new = tags.label_relation_rows(spark.createDataFrame(rows, "value string, type string, label map<string,string>, channel string"))
    stored = new.where(F.col("plain") == "p1").limit(1).withColumn("flag", F.lit(2)).withColumn("channel", F.lit("ch"))
    stored = stored.withColumn("label", F.create_map(F.lit("1"), F.lit("stale"), F.lit("9"), F.lit("kept")))
    out = {(r.channel, r.plain, r.md5, r.sha256): r for r in tags.resolve_entities(new.unionByName(stored)).collect()}
    merged = out[("ch", "p1", md5("p1"), sha("p1"))]
    assert merged.types == ["phone", "phonemd5", "phonesha256"] and merged.flag == 1
    assert merged.label == {"1": "md5", "2": "m", "3": "s", "9": "kept"}
    assert ("ch", None, md5("p2"), None) in out and ("ch", None, None, sha("p3")) in out
    assert len(out) == 4


def test_stamped_update_drops_list_tags(spark):
    full = spark.createDataFrame([("a", {"l1": ("1", "d0"), "x": ("2", "d0")}), ("b", {"l1": ("1", "d0")})], "k string, tags map<string,struct<value:string,day:string>>")
    new = spark.createDataFrame([("a", {"l2": "9"}), ("b", {"x": "5"})], "k string, tags map<string,string>")
    rows = {r.k: {t: tuple(v) for t, v in r.tags.items()} for r in tags.stamped_update(full, new, "k", F.lit("d1"), ["l1", "l2"]).collect()}
    assert rows == {"a": {"x": ("2", "d0"), "l2": ("9", "d1")}, "b": {"l1": ("1", "d0"), "x": ("5", "d1")}}


def test_category_slices_skip_empty(spark):
    df = spark.createDataFrame([("a", {"x": "1", "y": "2"}), ("b", {"y": "3"})], "k string, tags map<string,string>")
    rows = {(r.k, r.category): r.tags for r in tags.split_by_category(df, "k", {"p": ["x"], "q": ["y", "z"]}).collect()}
    assert rows == {("a", "p"): {"x": "1"}, ("a", "q"): {"y": "2"}, ("b", "q"): {"y": "3"}}


def test_interval_masks_cross_months():
    masks = bitmaps.interval_masks(date(2020, 9, 29), date(2020, 11, 2), CURRENT)
    assert masks[9] == 0b11 << 28 and masks[10] == (1 << 31) - 1 and masks[0] == 0b11
    assert sum(1 for m in masks if m) == 3


def test_interval_clamp():
    assert dates.clamp_interval("20180101", "20210101", "20201115") == ("20191101", "20201130")
    assert dates.clamp_interval("20200101", "20200201", "20201215") == ("20200101", "20200201")


def test_rule_outside_the_window_hits_nothing(spark):
    rows = [("a", "p", 3, date(2023, 3, 10)), ("b", "p", 3, date(2024, 3, 10)), ("c", "p", 3, date(2024, 1, 5))]
    df = spark.createDataFrame(rows, "device string, pkg string, status int, day date")
    current = date(2024, 1, 20)
    bm = activity.build_bitmaps(df, "device", "pkg", "status", "day", current)
    assert sorted(r.device for r in bm.collect()) == ["a", "c"]

    def kept(start, end):
        rule = IntervalRule(("p",), "active", start, end)
        return sorted(r.device for r in activity.activity_filter(None, bm, "device", "pkg", [rule], current).collect())

    assert kept(date(2021, 3, 1), date(2021, 3, 31)) == []
    assert kept(date(2024, 3, 1), date(2024, 3, 31)) == []
    assert kept(date(2021, 1, 1), date(2030, 1, 1)) == ["a", "c"]
    lists = spark.createDataFrame([("a", "p"), ("c", "p")], "device string, list string")
    by_list = lambda s, e: activity.activity_filter_by_list(lists, bm, "device", "pkg", "list", ",", "active", s, e, current).count()
    assert (by_list(date(2021, 3, 1), date(2021, 3, 31)), by_list(date(2021, 1, 1), date(2030, 1, 1))) == (0, 2)


def test_lifecycle_ignores_later_days(spark):
    rows = [("x", "d", "active", date(2024, 1, 1), 5), ("x", "d", "uninstall", date(2024, 2, 1), 9), ("x", "late", "install", date(2024, 2, 1), 1)]
    df = spark.createDataFrame(rows, "app string, device string, status string, day date, ms int")
    out = lifecycle.lifecycle_inputs(df, "app", "device", "day", "status", "ms", date(2024, 1, 20)).collect()
    assert [(r.device, r.cnt_day_30, r.uninstall_flag, r.duration) for r in out] == [("d", 1, 0, 5)]


def test_growth_and_health(spark):
    rows = [("a", date(2024, 1, 1), 5, 5, 0, 0), ("a", date(2024, 1, 2), 4, 2, 1, 8), ("b", date(2024, 1, 2), 3, 0, 0, 0), ("a", date(2023, 9, 1), 9, 0, 0, 0)]
    df = spark.createDataFrame(rows, "app string, day date, new int, active int, silent int, lost int")
    rates = lifecycle.growth_rates(df, "app", "day")
    growth = {(r.app, str(r.day)): r.growth for r in rates.collect()}
    assert growth[("a", "2024-01-02")] == pytest.approx(0.4) and growth[("b", "2024-01-02")] == 0
    out = {r.app: r for r in lifecycle.health_score(rates, "app", "day", date(2024, 1, 2)).collect()}
    assert out["a"].class_score == pytest.approx((99 + 100) / 2) and out["a"].growth_score == 100 and set(out) == {"a", "b"}


@pytest.fixture
def status_rows(spark):
    rows = [
        ("1", "PKG-1", 3, date(2020, 11, 3)), ("2", "pkg-1", 3, date(2020, 11, 4)), ("2", "pkg-2", 3, date(2020, 10, 4)),
        ("3", "pkg-1", 3, date(2020, 11, 9)), ("4", "pkg-1", 3, date(2020, 11, 1)), ("4", "pkg-2", 3, date(2020, 11, 2)),
        ("4", "pkg-3", 3, date(2020, 10, 31)), ("5", "pkg-9", 3, date(2020, 11, 1)), ("6", "pkg-1", -1, date(2020, 11, 5)),
    ]
    return spark.createDataFrame(rows, "device string, pkg string, status int, day date")


def _kept(spark, status_rows, restrict, include=True, seeds=("1", "2", "2", "3", "4", "5", "7")):
    bm = activity.build_bitmaps(status_rows, "device", "pkg", "status", "day", CURRENT)
    rule = IntervalRule(("pkg-1", "PKG-2", "pkg-3"), "active", date(2020, 10, 1), date(2020, 11, 30), restrict, include)
    df = None if seeds is None else spark.createDataFrame([(s,) for s in seeds], "device string")
    return sorted(r.device for r in activity.activity_filter(df, bm, "device", "pkg", [rule], CURRENT).collect())


def test_interval_filter_restrictions(spark, status_rows):
    assert _kept(spark, status_rows, "0") == ["1", "2", "2", "3", "4"]
    assert _kept(spark, status_rows, "1") == ["4"]
    assert _kept(spark, status_rows, "1,3") == ["1", "2", "2", "3"]
    assert _kept(spark, status_rows, "0", include=False) == ["5", "7"]
    assert _kept(spark, status_rows, "0", seeds=None) == ["1", "2", "3", "4"]


def test_bitmap_statuses(spark):
    rows = [("d", "p", s, date(2020, 11, i + 1)) for i, s in enumerate((-1, 0, 1, 2, 3))]
    df = spark.createDataFrame(rows, "device string, pkg string, status int, day date")
    row = activity.build_bitmaps(df, "device", "pkg", "status", "day", CURRENT).first()
    assert (row.installed[0], row.active[0], row.uninstall[0], row.new_install[0]) == (0b1111, 0b10000, 0b1, 0b100)
    none = activity.build_bitmaps(df.where("status = 3"), "device", "pkg", "status", "day", CURRENT).first()
    assert none.installed is None and len(none.active) == 13


def test_bitmap_increment_month_end_and_expiry(spark):
    df = spark.createDataFrame([("d", "p", 3, date(2020, 11, 29)), ("old", "p", 3, date(2019, 11, 20))], "device string, pkg string, status int, day date")
    state = activity.build_bitmaps(df, "device", "pkg", "status", "day", date(2020, 11, 29))
    today = spark.createDataFrame([("d", "p", 3), ("new", "p", 1)], "device string, pkg string, status int")
    once = activity.add_day(state, today, "device", "pkg", "status", date(2020, 11, 30))
    rows = {r.device: r for r in once.collect()}
    assert set(rows) == {"d", "new"}
    assert rows["d"].active[0] == 0 and rows["d"].active[11] == 0b11 << 28
    assert rows["new"].new_install[11] == 1 << 29 and rows["new"].active is None


def test_distribution_shares(spark):
    df = spark.createDataFrame([(1, {"g": "0"}), (2, {"g": "0"}), (3, {"g": "1"}), (4, {"g": "-1", "m": "1,2"}), (5, {}), (6, {"m": "2,2"})], "id int, tags map<string,string>")
    rows = {(r.label, r.value): (r.cnt, float(r.percent)) for r in distribution.label_distribution(df, "id", ["g", "m"]).collect()}
    assert rows[("g", "0")] == (2, 0.3333) and rows[("g", "unknown")] == (3, 0.5)
    assert rows[("m", "2")] == (2, 0.3333) and rows[("m", "unknown")] == (4, 0.6667)


def test_index_value(spark):
    sample = spark.createDataFrame([("d1", "a"), ("d1", "a"), ("d2", "b")], "device string, app string")
    base = spark.createDataFrame([("a", 0.35), ("b", 0.0)], "app string, population_share double")
    rows = distribution.index_against(distribution.penetration(sample, "app", "device"), base, "app").collect()
    assert [(r.app, round(r.tgi, 3)) for r in rows] == [("a", 142.857)]


def test_calibration_formula(spark):
    counts, ratio_a, ratio_b, total = [30.0, 50.0, 20.0], [0.5, 0.3, 0.2], [0.2, 0.5, 0.3], 80.0
    raw = [c * b / (sum(counts) * a) for c, a, b in zip(counts, ratio_a, ratio_b, strict=True)]
    expected_b = [r / sum(raw) * total for r in raw]
    expected = [(b + c) / (sum(expected_b) + sum(counts)) for b, c in zip(expected_b, counts, strict=True)]
    observed = spark.createDataFrame([("u", "l", str(i), c, c / 100) for i, c in enumerate(counts)], "g string, label string, value string, cnt double, share double")
    ratios = spark.createDataFrame([("l", str(i), a, b) for i, (a, b) in enumerate(zip(ratio_a, ratio_b, strict=True))], "label string, value string, ratio_a double, ratio_b double")
    totals = spark.createDataFrame([("u", total)], "g string, total_b double")
    rows = sorted(distribution.calibrate(observed, ratios, totals, ["g"]).collect(), key=lambda r: r.value)
    assert [r.cnt_b for r in rows] == pytest.approx(expected_b)
    assert [r.final_share for r in rows] == pytest.approx(expected)


@pytest.mark.parametrize(
    ("d90", "uninstall", "install", "expected"), [(0, 0, 1, 4), (5, 1, 1, 4), (1, 0, 1, 1), (2, 0, 0, 3), (3, 0, 0, 2)]
)
def test_lifecycle_class(spark, d90, uninstall, install, expected):
    df = spark.createDataFrame([(d90, uninstall, install)], "cnt_day_90 int, uninstall_flag int, install_flag int")
    assert lifecycle.lifecycle_class(df).first().user_type == expected


def test_score_bands(spark):
    df = spark.createDataFrame([(x,) for x in (0.95, 0.9, 0.75, 0.61, 0.5, 0.49)], "p double")
    assert [r.b for r in df.select(lifecycle.score_band(F.col("p")).alias("b")).collect()] == ["0.9", "0.9", "0.7", "0.6", "0.5", None]
