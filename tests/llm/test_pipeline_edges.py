"""Each stage of the pipeline on an empty table and on rows with nulls, repeats and clashing names."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm import frames

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_empty_table(spark, name, stage):
    docs = frames.empty(spark)
    out = stage(spark, docs, FOLDER)
    assert out.count() == 0
    assert name == "best_fit_packing" or sorted(out.columns) == sorted(docs.columns)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_edge_rows(spark, name, stage):
    docs = frames.edge(spark)
    out = stage(spark, docs, FOLDER)
    found = frames.ids(out)
    if name == "best_fit_packing":
        assert set(found) == set(frames.ALL_IDS)
        return
    assert sorted(out.columns) == sorted(docs.columns)
    if name == "ngram_join":
        assert found == [1, 2, 3, 4, 5, 6, 8, 9, 10, None]
    elif name == "language_id":
        assert not {1, 2, 3} & set(found) and found.count(7) in (0, 2)
    else:
        assert found == frames.ALL_IDS
