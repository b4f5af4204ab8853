"""Projection by loading tables, and the vector index, beside numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import projection, vector_index, vectors


def _long(spark, matrix):
    rows = [(f, c, float(matrix[f, c])) for f in range(matrix.shape[0]) for c in range(matrix.shape[1])]
    return spark.createDataFrame(rows, "feature long, component long, weight double")


def test_sparse_product_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.where(rng.random((80, 21)) < 0.2, rng.integers(1, 9, (80, 21)), 0).astype(float)
    x[:, 4] = 3.0  # in every row, without spread
    x[:, 5] = 0.0
    w = rng.normal(size=(21, 70))
    cells = spark.createDataFrame([(int(i), int(f), float(x[i, f])) for i, f in zip(*np.nonzero(x), strict=True)], "entity long, feature long, value double")
    statistics = projection.cell_statistics(cells, 80)
    spread = x.std(axis=0, ddof=1)
    z = np.divide(x - x.mean(axis=0), spread, out=np.zeros_like(x), where=spread > 1e-9)
    known = [f for f in range(21) if f != 5]
    expected = np.round(z[:, known] @ w[known], 3)
    rows = projection.project_cells(cells, _long(spark, w), statistics).collect()
    assert len(rows) == 80 * 70
    assert all(abs(r.score - expected[r.entity, r.component]) < 2e-3 for r in rows)


def test_whole_rows_against_numpy(spark):
    rng = np.random.default_rng(4)
    x, w = rng.normal(size=(50, 6)), rng.normal(size=(6, 4))
    rows = [(i, [float(v) for v in r], "keep") for i, r in enumerate(x)] + [(90, None, "n"), (91, [1.0], "short")]
    df = spark.createDataFrame(rows, "id int, v array<double>, note string").repartition(3)
    found = {r.id: (r.projected, r.note) for r in projection.project_rows(df, "v", 6, _long(spark, w)).collect()}
    assert found[90] == (None, "n") and found[91] == (None, "short")
    assert all(found[i][0] == pytest.approx(np.round(x[i] @ w, 3).tolist(), abs=1e-9) for i in range(50))
    empty = projection.project_rows(df.where("false"), "v", 6, _long(spark, w))
    assert empty.count() == 0 and empty.columns == ["id", "v", "note", "projected"]


def test_loadings_outside_the_vector_and_too_many_are_refused(spark, monkeypatch):
    with pytest.raises(ValueError):
        projection.loading_matrix(_long(spark, np.ones((7, 2))), 6)
    monkeypatch.setattr(projection, "MOST_WEIGHTS", 10)
    with pytest.raises(ValueError):
        projection.loading_matrix(_long(spark, np.ones((6, 2))), 6)


def test_fitted_loadings_pass_the_check_and_others_do_not(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5))
    df = spark.createDataFrame([(i, [*(float(v) for v in r), 2.0]) for i, r in enumerate(x)], "id int, v array<double>")
    scaled = vectors.standardise(df, "v", 6, "z").select("id", "z")
    loadings = projection.principal_loadings(scaled, "z", 3)
    rows = projection.check_loadings(df, "v", 6, loadings).orderBy("component").collect()
    values = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    assert [r.variance for r in rows] == pytest.approx(values[:3].tolist(), rel=1e-6)
    assert [r.share for r in rows] == pytest.approx((values[:3] / 5).tolist(), rel=1e-6)
    assert all(abs(r.norm - 1) < 1e-9 and r.overlap < 1e-9 and r.residual < 1e-6 for r in rows)
    scores = projection.project_rows(scaled, "z", 6, loadings).select(F.posexplode("projected").alias("c", "s")).groupBy("c").agg(F.var_samp("s").alias("v")).collect()
    assert {r.c: round(r.v, 2) for r in scores} == {i: round(float(v), 2) for i, v in enumerate(values[:3])}
    crooked = projection.check_loadings(df, "v", 6, _long(spark, np.array([[1.0, 1.0]] + [[0.0, 1.0]] * 5))).collect()
    assert all(r.residual > 0.1 and r.overlap == pytest.approx(1.0) for r in crooked)


def _clusters(spark, n=700, groups=12, dims=16):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(groups, dims)) * 3
    own = np.where(np.arange(n) % 3 == 0, 0, rng.integers(groups, size=n))  # a third in one group
    data = centre[own] + rng.normal(size=(n, dims))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(5000, [0.0] * dims), (5001, None)]
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 6)
    exact = {(i, j) for i in range(n) for _, j in sorted((-scores[i, j], j) for j in range(n) if j != i)[:10]}
    return spark.createDataFrame(rows, "id long, v array<double>"), exact


def test_index_finds_what_it_must(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "PART_ROWS", 40)  # lists and rows that ask are cut
    df, exact = _clusters(spark)
    index = vector_index.VectorIndex(df, "id", "v", lists=24)
    assert index.n == 700 and index.rows.groupBy("list", "part").count().agg(F.max("count")).first()[0] < 80
    whole = index.search(index.queries(), 10, index.lists).collect()
    assert len(whole) == 7000 and {(r.id, r.other) for r in whole} == exact
    probes = index.probes_for(10, 0.9, every=10)
    assert probes < index.lists // 2
    row = index.recall(10, probes, every=10).first()
    assert (row.queries, row.pairs) == (70, 700) and row.found >= 0.9 * row.pairs
    some = index.search(index.queries(), 10, probes).collect()
    assert len({(r.id, r.other) for r in some} & exact) >= 0.85 * len(exact)
    assert index.probes_for(10, 1.0, every=10) >= probes


def test_a_row_meets_many_short_lists_at_once(spark, monkeypatch):
    """Lists are searched in bundles: a row is copied once to each, not to each of its lists."""
    monkeypatch.setattr(vector_index, "PART_ROWS", 100)
    df, exact = _clusters(spark)
    index = vector_index.VectorIndex(df, "id", "v", lists=60)
    bundles, of = index._bundles()
    placed = {(r.list, r.part): r.bundle for r in bundles.collect()}
    held = {}
    for r in index.rows.collect():
        held[placed[r.list, r.part]] = held.get(placed[r.list, r.part], 0) + 1
        assert of[r.list][0] + r.part == placed[r.list, r.part]
    assert len(held) < 20 and max(held.values()) < 140
    for probes in (60, 59, 7):
        rows = index.search(index.queries(), 10, probes).collect()
        assert len(rows) == 7000 and len({(r.id, r.other) for r in rows} & exact) >= (7000 if probes > 58 else 5000)


def test_index_of_nothing_and_of_one(spark):
    df, _ = _clusters(spark, n=1)
    none = vector_index.VectorIndex(df.where("id > 4000"), "id", "v")
    assert none.search(none.queries(), 5, 3).count() == 0
    one = vector_index.VectorIndex(df, "id", "v")
    assert one.n == 1 and one.search(one.queries(), 5, 3).count() == 0
