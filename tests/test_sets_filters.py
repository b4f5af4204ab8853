from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import keys, maps, text
from cohortloom.operators import filters, ranking, sets


def _keys(spark, *values):
    return spark.createDataFrame([(str(v),) for v in values], "key string")


@pytest.fixture
def named(spark):
    return {"c1": _keys(spark, 1, 2, 4), "c2": _keys(spark, 5, 2, 4, 4), "c3": _keys(spark, 5, 4)}


@pytest.mark.parametrize(
    ("expression", "expected"),
    [
        ("c1 | c2 - c3", "12"),
        ("c1 | (c2 - c3)", "124"),
        ("c1 & c2", "24"),
        ("c3 - c1 | c1 & c2", "245"),
        ("((c2))", "245"),
        ("c1 - c1", ""),
    ],
)
def test_set_expression(named, expression, expected):
    rows = sets.set_expression(named, expression, "key").collect()
    assert "".join(sorted(r.key for r in rows)) == expected


@pytest.mark.parametrize("expression", ["c1 c2", "c1 |", "| c1", "(c1", "c1)", "c9", "", "()"])
def test_set_expression_rejects(named, expression):
    with pytest.raises(ValueError):
        sets.set_expression(named, expression, "key")


def test_set_counts_keep_duplicates(named):
    rows = {r.set_name: r.cnt for r in sets.set_counts(named, "key").collect()}
    assert rows == {"c1": 3, "c2": 4, "c3": 2, "total": 9}


@pytest.mark.parametrize(
    ("expression", "kept"),
    [(">=3&<9", ["3", "8.5"]), ("<3|>=9", ["2", "9"]), ("!=3", ["2", "8.5", "9"]), ("", [""]), ("= 3", ["3"])],
)
def test_numeric_expression(spark, expression, kept):
    df = spark.createDataFrame([("2",), ("3",), ("8.5",), ("9",), ("x",), ("",), (None,)], "v string")
    rows = df.where(filters.numeric_condition(F.col("v"), expression)).collect()
    assert [r.v for r in rows] == kept


def test_numeric_expression_limits():
    with pytest.raises(ValueError):
        filters.numeric_condition(F.lit("1"), ">1&<2&>0")
    with pytest.raises(ValueError):
        filters.numeric_condition(F.lit("1"), "about 3")


def test_map_tag_filter_missing_and_multi(spark):
    df = spark.createDataFrame(
        [(1, {"3_1000": "2,3"}), (2, {"3_1000": "4"}), (3, {}), (4, {"3_1000": "2", "4_1000": "9"})],
        "id int, tags map<string,string>",
    )
    assert [r.id for r in filters.map_tag_filter(df, {"3_1000": "3,2"}, {"4_1000": "9"}).collect()] == [1]
    assert [r.id for r in filters.map_tag_filter(df, {}, {"3_1000": "2"}).collect()] == [2, 3]


def test_attribute_filter_null_list_is_false(spark):
    df = spark.createDataFrame([(1, "a,b", 5), (2, None, 5), (3, "c", None)], "id int, tags string, age int")
    keep = lambda inc, exc: [r.id for r in filters.attribute_filter(df, inc, exc, ["age"]).collect()]
    assert keep({"tags": "b,z"}, {}) == [1]
    assert keep({}, {"tags": "a"}) == [2, 3]
    assert keep({"age": "5", "tags": " "}, {}) == [1, 2]


def test_category_parent(spark):
    df = spark.createDataFrame([(1, "7015_022,7002"), (2, "7002_001")], "id int, catelist string")
    kept = filters.attribute_filter(df, {"catelist": "7015"}, {}, [], hierarchical=["catelist"])
    assert [r.id for r in kept.collect()] == [1]


def test_geohash_prefix(spark):
    df = spark.createDataFrame([(1, "WX4G0,", None), (2, None, "w5"), (3, "", None)], "id int, home string, work string")
    kept = df.where(filters.geohash_prefix_match([F.col("home"), F.col("work")], ["wx4g0ec1", "u4pru"]))
    assert [r.id for r in kept.collect()] == [1]


def test_check_digit(spark):
    df = spark.createDataFrame([("49015420323751",), ("1234567890123",), ("4901542032375x",)], "k string")
    rows = df.select(keys.clean(F.col("k"), fill_check_digit=True).alias("k")).collect()
    assert [r.k for r in rows] == ["490154203237518", "1234567890123", "4901542032375x"]


def test_colons_and_canonical(spark):
    df = spark.createDataFrame([(" AABBCCDDEEFF ",), ("aa:bb:cc:dd:ee:ff",)], "k string")
    rows = df.select(keys.canonical(F.col("k"), colons=True).alias("k")).collect()
    assert {r.k for r in rows} == {"aa:bb:cc:dd:ee:ff"}


def test_undecryptable_is_null(spark):
    df = spark.range(1).select(keys.decrypt_text(F.lit("bm90IGEgY2lwaGVyIHRleHQgYXQgYWxsLCBub3Q="), F.lit("0123456789abcdef")).alias("p"))
    assert df.first().p is None


def test_pack_nonzero(spark):
    df = spark.createDataFrame([("1.23456", "0", "x", None), ("0.0", "", " ", "0")], "a string, b string, c string, d string")
    packed = text.pack_nonzero(["a", "b", "c", "d"], [F.col(c) for c in "abcd"])
    assert [r.p for r in df.select(packed.alias("p")).collect()] == ["a,c=1.2346,x", None]


def test_merge_maps_prefers_asked_side(spark):
    df = spark.sql("select map('a','1','b','2') as l, map('b','3','c','4') as r")
    row = df.select(
        maps.merge_maps(F.col("l"), F.col("r"), "left").alias("left"), maps.merge_maps(F.col("l"), F.col("r"), "right").alias("right"),
        maps.merge_maps(F.lit(None).cast("map<string,string>"), F.col("r"), "left").alias("none"),
    ).first()
    assert row["left"] == {"a": "1", "b": "2", "c": "4"}
    assert row["right"] == {"a": "1", "b": "3", "c": "4"}
    assert row["none"] == {"b": "3", "c": "4"}


def test_top_k_salted_equals_plain(spark):
    # One key holds a third of the rows.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 7919 % 3001).alias("v"))
    order = [F.desc("v")]
    plain = ranking.top_k_per_group(df, ["k"], order, 5, salts=1).collect()
    salted = ranking.top_k_per_group(df, ["k"], order, 5, salts=16).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, salted))


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = ranking.top_k_per_group(df, ["k"], [F.desc("id")], 5)._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial and plan.index("Partial") > plan.index("Exchange")


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(13)
    rows = ranking.global_index(df, ["v"], "n").collect()
    assert sorted((r.v, r.n) for r in rows) == [(i, i + 1) for i in range(1000)]


def test_set_expression_is_one_shuffle(named):
    plan = sets.set_expression(named, "c1 | c2 - c3 & c1", "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_crowded_keys_and_samples(spark):
    df = spark.range(100).select((F.col("id") % 10 * F.when(F.col("id") < 50, 0).otherwise(1)).alias("k"), "id")
    assert {r.k for r in filters.drop_crowded_keys(df, "k", 5).collect()} == set(range(1, 10))
    parts = [filters.hash_sample(df, "id", 4, b).count() for b in range(4)]
    assert sum(parts) == 100 and all(parts)
