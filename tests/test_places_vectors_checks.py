from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.functions import geo
from cohortloom.operators import checks, nearest, places, vectors, web


def _haversine(a, b, c, d):
    x = math.sin(math.radians(a - c) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(b - d) / 2) ** 2
    return round(2 * math.asin(math.sqrt(x)) * 6367000.0, 6)


@pytest.mark.parametrize(("centre_lat", "centre_lon", "metres"), [(20.0, 100.0, 800), (-64.0, 179.99, 3000), (0.0, -180.0, 1500), (70.0, -179.995, 5000), (89.93, 30.0, 13000), (-89.95, 179.0, 9000), (10.0, 0.0, 9_000_000)])
def test_grid_join_against_brute_force(spark, centre_lat, centre_lon, metres):
    rng = random.Random(3)

    def near():
        lon = centre_lon + rng.uniform(-0.15, 0.15) * (1 if abs(centre_lat) < 80 else 1200)
        return max(-90.0, min(90.0, centre_lat + rng.uniform(-0.08, 0.08))), (lon + 180) % 360 - 180

    points = [(i, *near()) for i in range(150)]
    pois = [(f"p{i}", *near()) for i in range(120)]
    pdf = spark.createDataFrame(points, "id int, lat double, lon double")
    qdf = spark.createDataFrame(pois, "poi_name string, poi_lat double, poi_lon double")
    rows = places.within_distance(pdf, qdf, metres).collect()
    expected = {(i, n) for i, a, b in points for n, c, d in pois if _haversine(a, b, c, d) < metres}
    assert len(rows) == len(expected) and {(r.id, r.poi_name) for r in rows} == expected


@pytest.mark.parametrize("cell_points", [None, 9])
def test_a_crowded_cell_is_dealt_over_tasks(spark, cell_points):
    points = spark.createDataFrame([(i, 10.0 + i % 7 / 1e5, 20.0) for i in range(60)], "id int, lat double, lon double")
    pois = spark.createDataFrame([(f"p{i}", 10.0, 20.0 + i / 1000) for i in range(20)], "poi_name string, poi_lat double, poi_lon double")
    rows = places.within_distance(points, pois, 1000, cell_points).collect()
    assert len(rows) == sum(_haversine(10.0 + i % 7 / 1e5, 20.0, 10.0, 20.0 + j / 1000) < 1000 for i in range(60) for j in range(20))


@pytest.mark.parametrize(("lat", "lon", "metres"), [(20.0, 100.0, 3000), (-65.0, 179.995, 4000), (89.9, 0.0, 20000), (0.0, 0.0, 500_000)])
def test_nearest_in_crowds_against_brute_force(spark, lat, lon, metres):
    rng = random.Random(11)

    def near(size):
        x = lon + rng.uniform(-size, size) * (1 if abs(lat) < 80 else 500)
        return max(-90.0, min(90.0, lat + rng.uniform(-size, size))), (x + 180) % 360 - 180

    wide = 2 * metres / 111_000
    spots = [near(wide) for _ in range(120)] + [near(1e-4) for _ in range(40)]
    spread = [near(wide) for _ in range(60)] + [near(1e-3) for _ in range(200)] + [near(1e-5) for _ in range(200)] + [spots[3]] * 3
    pois = [(rng.choice([1, 1, 1, 2, 3]), f"p{i % 50}", *p) for i, p in enumerate(spread)]
    pdf = spark.createDataFrame([*spots, (None, 1.0)], "lat double, lon double")
    qdf = spark.createDataFrame([*pois, (None, "x", lat, lon), (1, "y", None, lon)], "poi_type int, poi_name string, poi_lat double, poi_lon double")
    expected = {}
    for a, b in spots:
        for kind, name, c, d in pois:
            far = _haversine(a, b, c, d)
            if far < metres:
                expected[a, b, kind] = max(expected.get((a, b, kind), (-1e18, "")), (-far, name))
    rows = nearest.nearest_per_type(pdf, qdf, metres, leaf=4).collect()
    found = {(r.lat, r.lon, r.poi_type): (r.distance, r.poi_name) for r in rows}
    assert len(rows) == len(found) and set(found) == set(expected)
    assert all(found[k][1] == v[1] and abs(found[k][0] + v[0]) < 1e-5 for k, v in expected.items())


def test_nearest_of_many_is_searched_in_its_cell(spark, monkeypatch):
    """Two hundred places of a type in a cell: no row for each point and cell of a tree, and none for each pair."""
    rng = random.Random(5)
    spots = [(20.0 + rng.random() * 0.1, 100.0 + rng.random() * 0.1) for _ in range(700)]
    spread = [(rng.choice([1, 2, None]), f"p{i % 900}", 20.0 + rng.random() * 0.1, 100.0 + rng.random() * 0.1) for i in range(6000)]
    pdf = spark.createDataFrame([*spots, (float("nan"), 100.0)], "lat double, lon double")
    qdf = spark.createDataFrame(spread, "poi_type int, poi_name string, poi_lat double, poi_lon double")
    stored, original = [], nearest._stored
    monkeypatch.setattr(nearest, "_stored", lambda df, name: stored.append(name) or original(df, name))
    rows = nearest.nearest_per_type(pdf, qdf, 2500).collect()
    assert stored == ["places"] and len(rows) == 1400
    places_of = {k: np.array([(c, d) for kind, _, c, d in spread if kind == k]) for k in (1, 2)}
    for r in rows:
        at = places_of[r.poi_type]
        half = np.sin(np.radians(at - [r.lat, r.lon]) / 2) ** 2
        far = 2 * 6367000.0 * np.arcsin(np.sqrt(half[:, 0] + np.cos(np.radians(r.lat)) * np.cos(np.radians(at[:, 0])) * half[:, 1]))
        assert abs(far.min() - r.distance) < 1e-5 and (r.poi_lat, r.poi_lon) == tuple(at[far.argmin()])


def test_nearest_of_hot_cells_is_dealt_over_tasks(spark, monkeypatch):
    rng = random.Random(6)
    spots = spark.createDataFrame([(10 + rng.random() / 50, 10 + rng.random() / 50) for _ in range(300)], "lat double, lon double")
    pois = spark.createDataFrame([(i % 7, f"p{i}", 10 + rng.random() / 50, 10 + rng.random() / 50) for i in range(400)], "poi_type long, poi_name string, poi_lat double, poi_lon double")
    whole = {tuple(r) for r in nearest.nearest_per_type(spots, pois, 5000).collect()}
    monkeypatch.setattr(nearest, "POINT_ROWS", 20)
    monkeypatch.setattr(nearest, "PLACE_ROWS", 50)
    rows = nearest.nearest_per_type(spots, pois, 5000).collect()
    assert len(whole) == len(rows) == 2100 and {tuple(r) for r in rows} == whole


def test_nearest_ties_by_greater_name(spark):
    points = spark.createDataFrame([(1, 10.0, 10.0), (2, 10.0, 10.0), (3, 50.0, 50.0)], "id int, lat double, lon double")
    pois = spark.createDataFrame([(1, "a", 10.001, 10.0), (1, "b", 10.001, 10.0), (2, "z", 10.0, 10.0005)], "poi_type int, poi_name string, poi_lat double, poi_lon double")
    best = nearest.nearest_per_type(points, pois, 500)
    assert sorted((r.poi_type, r.poi_name) for r in best.collect()) == [(1, "b"), (2, "z")]
    wide = {r.id: r for r in places.typed_columns(points, best, [1, 2, 3]).collect()}
    assert wide[1].type_1.poi_name == wide[2].type_1.poi_name == "b" and wide[1].type_3 is None
    assert wide[3].type_1 is None and abs(wide[3].geohash_center8.lat - 50.0) < 0.001
    assert places.typed_columns(points, best, [1], keep_empty=False).count() == 2


def test_polygon_boundary(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 2.0), (0.0, 4.0)]
    rows = [(1.0, 1.0, True), (0.0, 2.0, True), (2.0, 2.0, True), (4.0, 4.0, True), (2.0, 3.0, False), (5.0, 1.0, False), (0.5, 3.0, True), (2.0, 1.0, True), (None, 1.0, False)]
    df = spark.createDataFrame(rows, "lon double, lat double, inside boolean")
    got = df.select("inside", geo.inside_polygon(F.col("lat"), F.col("lon"), square).alias("got")).collect()
    assert all(r.inside == r.got for r in got)
    assert not spark.range(1).select(geo.inside_polygon(F.lit(0.0), F.lit(0.0), square[:2]).alias("x")).first().x


def test_geohash_reference_value(spark):
    assert spark.range(1).select(geo.geohash(F.lit(57.64911), F.lit(10.40744), 8).alias("h")).first().h == "u4pruydq"


def test_root_domain_prefers_the_longer_suffix(spark):
    df = spark.createDataFrame([("http://a.b.com.cn/x/*",), ("shop.co.com/p?q=1",), ("localhost/",), ("https://com.cn",)], "url string")
    suffixes = spark.createDataFrame([("com",), ("cn",), ("com.cn",), ("com.cn",)], "domain string")
    rows = [(r.host, r.root_domain) for r in web.root_domain(web.parse_urls(df), suffixes).orderBy("host").collect()]
    assert rows == [("a.b.com.cn", "b.com.cn"), ("com.cn", ""), ("localhost", "localhost"), ("shop.co.com", "co.com")]


def test_cosine_blocks_against_numpy(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(90, 8))
    data[10] = data[11]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(999, [0.0] * 8)], "id long, v array<double>")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 6)
    expected = set()
    for i in range(90):
        ranked = sorted((-scores[i, j], j) for j in range(90) if j != i)[:7]
        expected |= {(i, j, -s) for s, j in ranked}
    for side in (1, 5, None):
        rows = vectors.cosine_top_k(df, "id", "v", 7, side=side).collect()
        assert {(r.id, r.other, r.score) for r in rows} == expected and len(rows) == 90 * 7


@pytest.mark.parametrize("copies", [0, 300])
def test_block_top_in_slices_of_columns(monkeypatch, copies):
    """Few pairs are measured in double: the others cannot be among the best. Equal scores go by the smaller id."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(1500, 24))
    x[:copies] = x[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = rng.permutation(1500)
    monkeypatch.setattr(vectors, "SLICE_COLUMNS", 128)
    measured, original = [], np.einsum
    monkeypatch.setattr(vectors.np, "einsum", lambda *a, **b: measured.append(len(out := original(*a, **b))) or out)
    found = vectors.block_top(5, [(ids, x, ids, x)])
    scores = np.round(x @ x.T, 6)
    expected = {(ids[i], ids[j], scores[i, j]) for i in range(1500) for j in sorted(set(range(1500)) - {i}, key=lambda j: (-scores[i, j], ids[j]))[:5]}
    assert len(found) == 7500 and set(zip(found["id"], found["other"], found["score"], strict=True)) == expected
    assert 0 < sum(measured) < 1500 * 1500 / 10


def test_mean_standardise_project(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0]), (1, [3.0, 5.0]), (2, [8.0, 5.0])], "k int, v array<double>")
    assert {r.k: r["mean"] for r in vectors.mean_vector(df, ["k"], "v", 2).collect()} == {1: [2.0, 5.0], 2: [8.0, 5.0]}
    scaled = sorted(r.scaled[0] for r in vectors.standardise(df, "v", 2).collect())
    assert scaled == pytest.approx([-3 / math.sqrt(13), -1 / math.sqrt(13), 4 / math.sqrt(13)])
    assert {r.scaled[1] for r in vectors.standardise(df, "v", 2).collect()} == {0.0}
    assert [r.projected for r in vectors.project(df, "v", [[1.0, 1.0], [0.5, 0.0]]).collect()] == [[6.0, 0.5], [8.0, 1.5], [13.0, 4.0]]


def test_projection_agrees_with_fitted_components(spark):
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(40, 4)))], "id int, v array<double>")
    with_vector = df.withColumn("f", array_to_vector("v"))
    model = PCA(k=2, inputCol="f", outputCol="o").fit(with_vector)
    fitted = {r.id: [round(x, 3) for x in r.o] for r in model.transform(with_vector).select("id", vector_to_array("o").alias("o")).collect()}
    given = {r.id: r.projected for r in vectors.project(df, "v", model.pc.toArray().T.tolist()).collect()}
    assert all(given[i] == pytest.approx(fitted[i], abs=0.0011) for i in fitted)


def test_harmonic_fusion(spark):
    def space(*rows):
        return spark.createDataFrame(rows, "id int, other int, score double")

    rows = vectors.fuse_scores([space((1, 2, 0.5), (1, 3, 0.0)), space((1, 2, 0.25), (1, 4, 0.4)), space((1, 2, 0.0))]).collect()
    got = {(r.id, r.other): r.score for r in rows}
    assert got == {(1, 2): pytest.approx(2 / (1 / 0.5 + 1 / 0.25)), (1, 3): 0.0, (1, 4): pytest.approx(0.4)}


def test_quantiles_with_a_hot_value(spark):
    rng = random.Random(2)
    values = [5.0] * 400 + [rng.random() * 100 for _ in range(600)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 1.0)], "g string, v double")
    counts = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    levels = [0.01, 0.3, 0.5, 0.95, 1.0]
    rows = {(r.g, r.level): r.v for r in checks.exact_quantiles(counts, "g", "v", "n", levels).collect()}
    ordered = sorted(values)
    assert [rows[("g", p)] for p in levels] == [ordered[max(math.ceil(round(p * 1000, 6)), 1) - 1] for p in levels]
    assert all(rows[("h", p)] == 1.0 for p in levels)


def test_consistency_treats_null_as_empty(spark):
    stored = spark.createDataFrame([(1, "a", "x"), (2, "a", "1,2=a,b"), (3, "a", "y"), (4, "a", " ")], "k int, tag string, value string")
    served = spark.createDataFrame([(1, "a", "x"), (2, "a", "2,1=b,a")], "k int, tag string, value string")
    row = checks.consistency(stored, served, "k", 10).first()
    assert (row.sampled, row.mismatched) == (3, 1)


def test_missing_partitions(spark):
    expected = spark.createDataFrame([("s", "1"), ("s", "2")], "source string, day string")
    present = spark.createDataFrame([("s", "1"), ("s", "1")], "source string, day string")
    assert [tuple(r) for r in checks.missing_partitions(expected, present, ["source", "day"]).collect()] == [("s", "2")]


def test_metres_are_rounded_as_spark_rounds(spark):
    rng = random.Random(5)
    values = [rng.uniform(0, 10 ** rng.uniform(-7, 7.7)) for _ in range(4000)] + [i / 8 for i in range(100)] + [1.0000005, 0.1234565, 2.675, 1e-7, 4.5e7]
    values += [i / 2000 for i in range(1, 2000, 2)] + [float("nan"), float("inf"), -1.5, -0.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for places_ in (6, 3):
        assert df.where(~geo.round_metres(F.col("x"), places_).eqNullSafe(F.round("x", places_))).collect() == []


def test_a_place_at_the_bound_is_measured(spark):
    points = spark.createDataFrame([(1, 10.0, 20.0)], "id int, lat double, lon double")
    pois = spark.createDataFrame([("p", 10.0, 20.001)], "poi_name string, poi_lat double, poi_lon double")
    bound = places.within_distance(points, pois, 1000).first()["distance"]
    for step, kept in ((0.0, 0), (1e-6, 1), (-1e-6, 0), (1.0, 1), (-1.0, 0)):
        assert places.within_distance(points, pois, bound + step).count() == kept


def _topic_texts(spark, copies=1):
    rng = random.Random(2)
    topics = [[f"{t}{i}" for i in range(30)] for t in "abc"]
    texts = [(i, " ".join(rng.choices(topics[i % 3], k=40))) for i in range(240)]
    rows = [*texts, *[(1000 + i, t) for i, t in texts[:copies]], (2000, ""), (2001, None), (2002, "once_only"), (2003, "The of")]
    return spark.createDataFrame(rows, "id int, text string")


def test_word_vectors_tell_topics_apart_over_many_slices(spark, monkeypatch):
    from cohortloom.operators import word_vectors

    monkeypatch.setattr(word_vectors, "SLICE_WORDS", 600)
    found = {r.id: r for r in vectors.text_embedding(_topic_texts(spark, 20), "text", ["the", "of"], minimum_count=2, size=16).collect()}
    assert len(found) == 264 and all(len(r.embedding) == 16 for r in found.values())
    assert all(not any(found[i].embedding) for i in (2000, 2001, 2003)) and found[2001].tokens is None and found[2003].tokens == []
    # Copies lie in other slices and have the same vector.
    assert all(found[1000 + i].embedding == found[i].embedding for i in range(20))
    units = np.array([found[i].embedding for i in range(240)])
    units -= units.mean(0)
    units /= np.linalg.norm(units, axis=1)[:, None]
    scores = units @ units.T - 9 * np.eye(240)
    assert (scores.argmax(1) % 3 == np.arange(240) % 3).mean() > 0.95


def test_word_vectors_do_not_depend_on_the_partitions(spark):
    a, b = (
        {r.id: r.embedding for r in vectors.text_embedding(_topic_texts(spark).repartition(n), "text", [], minimum_count=2, size=8).collect()} for n in (1, 7)
    )
    assert a == b and any(a[0])


def test_a_task_holds_the_vectors_of_its_own_words_only(spark, monkeypatch):
    """The vocabulary grows with the table; no slice and no driver has all of it."""
    from cohortloom.operators import word_vectors

    monkeypatch.setattr(word_vectors, "SLICE_WORDS", 200)
    own = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(20)) + f" w{i}x0") for i in range(100)], "id int, text string")
    rows = vectors.text_embedding(own, "text", [], minimum_count=2, size=8)
    plan = rows._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[-1].count("FlatMapCoGroupsInArrow") == 2
    assert all(any(r.embedding) for r in rows.collect())


@pytest.mark.parametrize(("lat", "lon", "metres"), [(20.0, 100.0, 3000), (-65.0, 179.995, 4000), (89.9, 0.0, 20000), (0.0, -180.0, 90_000), (45.0, -170.0, 0.5)])
def test_the_distance_by_chord_is_the_haversine(spark, lat, lon, metres):
    """The same double, also where the chord says too little to round, and beside the bound."""
    size = metres / 100_000
    shift = [F.rand(s) * 2 * size - size for s in (1, 2, 3, 4)]
    wide = 500 if lat > 80 else 1
    points = spark.range(400).select("id", F.least(F.lit(lat) + shift[0], F.lit(90.0)).alias("lat"), (F.lit(lon) + shift[1] * wide).alias("lon"))
    pois = spark.range(400).select(F.col("id").alias("poi_name"), F.least(F.lit(lat) + shift[2], F.lit(90.0)).alias("poi_lat"), (F.lit(lon) + shift[3] * wide).alias("poi_lon"))
    points, pois = (spark.createDataFrame(df.collect(), df.schema) for df in (points, pois))
    found = {(r.id, r.poi_name): r.distance for r in places.within_distance(points, pois, metres).collect()}
    every = points.crossJoin(pois).withColumn("d", geo.haversine_m(F.col("lat"), F.col("lon"), F.col("poi_lat"), F.col("poi_lon"))).where(F.col("d") < metres)
    assert found == {(r.id, r.poi_name): r.d for r in every.collect()} and len(found) > 1000


def test_the_pairs_are_made_by_a_method_that_java_compiles(spark):
    """Java interprets a method of more than 8000 bytes: the join's loop stays well below."""
    points = spark.createDataFrame([(1, 80.0, 3.0), (2, None, 1.0)], "id int, lat double, lon double")
    pois = spark.createDataFrame([("a", 80.0, 3.01), ("b", 80.0, None)], "poi_name string, poi_lat double, poi_lon double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = places.within_distance(points, pois, 15000)
        assert [(r.id, r.poi_name) for r in met.collect()] == [(1, "a")]
        stages = met._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()) if "MergeJoin" in stages.apply(i)._1()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 1 and 0 < sizes[0] < 5000
