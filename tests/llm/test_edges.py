"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import best_fit_packing, chat_roles, decontamination, gru_lm, host_rules, language_id, ngram_join, token_counts, toxicity, vector_sharding
from cohortloom.llm.textbytes import pieces
from tests.llm import frames


@pytest.fixture(scope="module")
def docs(spark):
    return frames.edge(spark).cache()


def test_ngram_join(spark, docs):
    rows = {r.doc_id: r for r in ngram_join.near_duplicates(docs).collect()}
    assert frames.ids(ngram_join.near_duplicates(docs)) == frames.ALL_IDS
    assert rows[6].class_id == rows[7].class_id == 6 and rows[7].n_copies == 3 and rows[7].n_links == 0
    assert rows[1].class_id == 1 and rows[2].class_id == 2 and rows[3].class_id == 3
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns and frames.ids(kept) == [1, 2, 3, 4, 5, 6, 8, 9, 10, None]
    assert ngram_join.near_duplicates(frames.empty(spark)).count() == 0
    assert ngram_join.one_of_each(frames.empty(spark)).count() == 0


def test_ids_that_repeat_with_other_texts_stay_once(spark):
    text = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(1, text), (2, text), (2, "quite another text than the first one here"), (3, "quite another text than the first one here")], "doc_id long, text string")
    assert frames.ids(ngram_join.one_of_each(df)) == [1, 2]


def test_each_text_stays_once_whatever_ids_repeat(spark):
    one, two = "one two three four five six seven eight nine ten", "quite another text than the first one here"
    rows = [(1, one, "b"), (2, one, "b"), (2, two, "b"), (2, two, "a"), (3, two, "b")]
    rows += [(9, f"text number {i} of the id nine, with words of its own: {i * 7919} {i * 104729}", "c") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _place string")
    kept = [tuple(r) for r in ngram_join.one_of_each(df).collect()]
    assert sorted(kept) == sorted([(1, one, "b"), (2, two, "a"), *rows[5:]])


def test_rows_without_an_id_are_compared(spark):
    words = [f"w{i}" for i in range(60)]
    one, near, other = " ".join(words), " ".join([*words, "more"]), " ".join(reversed(words))
    df = spark.createDataFrame([(None, one), (None, one), (4, near), (None, other), (None, other)], "doc_id long, text string")
    found = sorted((r.doc_id is None, r.class_id or 0, r.n_links, r.copy_of or 0, r.n_copies) for r in ngram_join.near_duplicates(df).collect())
    assert found == [(False, 4, 1, 4, 1), (True, 0, 0, 0, 2), (True, 0, 0, 0, 2), (True, 4, 1, 0, 2), (True, 4, 1, 0, 2)]
    assert sorted(r.text for r in ngram_join.one_of_each(df).collect()) == sorted([near, other])


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, docs, rule):
    rows = token_counts.line_counts(docs, rule=rule).collect()
    assert sorted({(r.doc_id is None, r.doc_id or 0) for r in rows}) == sorted({(i is None, i or 0) for i in frames.ALL_IDS})
    assert [(r.section, r.n_tokens) for r in rows if r.doc_id in (1, 2)] == [(0, 0.0), (0, 0.0)]
    assert [(r.section, r.start, r.end) for r in rows if r.doc_id == 3] == [(0, 0, 2), (1, 2, 5)]
    assert token_counts.line_counts(frames.empty(spark), rule=rule).count() == 0
    fields = token_counts.field_counts(docs, ["text", "lang"], rule=rule)
    assert fields.count() == 2 * len(frames.ALL_IDS) and {r.field for r in fields.collect()} == {"text", "lang"}


def test_language_model(spark, docs):
    scored = gru_lm.fit_and_score(docs, F.lit(True)).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in scored)) == sorted((i is None, i or 0) for i in frames.ALL_IDS)
    by = {r.doc_id: r for r in scored}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1 and by[1].score == by[2].score
    assert by[5].n_tokens == 42001 and all(r.score < 0 and r.n_known == r.n_tokens for r in scored)
    untaught = gru_lm.fit_and_score(docs, F.lit(False)).collect()
    assert len(untaught) == len(scored) and all(r.n_known == 0 and r.train_tokens == 0 and r.score < 0 for r in untaught)
    assert gru_lm.fit_and_score(frames.empty(spark), F.lit(True)).count() == 0


def test_a_long_word_costs_its_whole_spelling(spark):
    words = ["".join(chr(97 + (i * i + 3 * i) % 23) for i in range(size)) + "zq" for size in (10, 100, 10_000)]
    common = " ".join(f"{chr(97 + i % 26)}{i}" for i in range(400))
    taught = spark.createDataFrame([(1, f"{common} {common}"), (2, "y" * 5000 + "zq izq")], "doc_id long, text string")
    counts = gru_lm.word_counts(taught).cache()
    model = gru_lm.fit(taught, counts, F.xxhash64("doc_id"))
    t = gru_lm.tokens_of(next(iter(pieces(pa.array([" ".join(words)])))))
    spelled = dict(zip((t.ends - t.starts)[t.example].tolist(), model.word_scores(t, np.arange(3)).tolist(), strict=True))
    assert spelled[10_002] < -1000
    asked = spark.createDataFrame([*enumerate(words), (3, "y" * 5000 + "zq"), (4, common)], "doc_id long, text string")
    by = {r.doc_id: r.score for r in gru_lm.score(asked, counts, model).collect()}
    for i, size in ((1, 102), (2, 10_002)):
        assert by[i] - by[0] == pytest.approx(spelled[size] - spelled[12], rel=1e-4, abs=1e-3)
    # Counts that are joined give the scores of counts that the tasks know.
    known, own = model.known, model.known.hot_units >= 0
    cold = replace(model, known=replace(known, hot=known.hot[own], hot_counts=known.hot_counts[own], hot_units=known.hot_units[own]))
    assert not own.all() and by[3] > -20
    assert {r.doc_id: r.score for r in gru_lm.score(asked, counts, cold).collect()} == pytest.approx(by, rel=1e-6)


def test_chat_roles(spark):
    rows = [(1, 0, "user", "User: hi"), (1, 0, "user", "User: hi"), (1, 1, "assistant", None), (None, 0, "user", "x"), (2, None, "system", ""), (2, 3, None, "a\n\nb"), (3, 0, "robot", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS chunk", "2 AS conv", "'z' AS marker", "4 AS state")
    model = chat_roles.learn(chat_roles.lines_of(df, "conv_id", "turn", "text", "role"))
    turns = chat_roles.recover(chat_roles.lines_of(df, "conv_id", "turn", "text"), model).collect()
    assert sum(r.n_lines for r in turns) == 8 and {r.conv for r in turns} >= {"1", "2", "3"}
    none = df.where("false")
    assert chat_roles.recover(chat_roles.lines_of(none, "conv_id", "turn", "text"), chat_roles.learn(chat_roles.lines_of(none, "conv_id", "turn", "text", "role"))).count() == 0


def test_sharding(spark, docs):
    rows = vector_sharding.shard(docs, shards=3).collect()
    assert len(rows) == len(frames.ALL_IDS) and {r.size for r in rows if r.doc_id in (1, 2)} == {16}
    for s in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own))) and 0 <= s < 3
    assert vector_sharding.shard(frames.empty(spark)).count() == 0


def test_host_rules(spark, docs):
    rows = host_rules.judge(docs)
    assert frames.ids(rows) == frames.ALL_IDS
    assert not any(r.kept for r in rows.where("doc_id in (1, 2, 3, 4)").collect())
    assert host_rules.judge(frames.empty(spark)).count() == 0


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(5, "quick BROWN fox, jumps"), (6, None), (7, "..."), (None, "the quick brown"), (5, "quick brown fox jumps"), (40, "lazy dog")], "item_id long, text string").selectExpr("*", "1 AS item", "2 AS n_words")
    windows = decontamination.benchmark_windows(bench)
    found = decontamination.digest(decontamination.find_contamination(docs, windows))
    assert frames.ids(found) == frames.ALL_IDS and [r.doc_id for r in found.where("contaminated").collect()] == [8]
    kept = decontamination.decontaminate(docs, windows)
    assert kept.columns == docs.columns and 8 not in frames.ids(kept) and kept.count() == len(frames.ALL_IDS) - 1
    cut = decontamination.decontaminate(docs, windows, remove="spans")
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert "fox" not in texts[8] and texts[8].startswith("the ") and texts[1] is None and cut.columns == docs.columns
    nothing = decontamination.benchmark_windows(bench.where("false"))
    assert decontamination.decontaminate(docs, nothing).count() == len(frames.ALL_IDS)
    assert decontamination.find_contamination(frames.empty(spark), windows).count() == 0
    with pytest.raises(ValueError):
        decontamination.decontaminate(docs, windows, remove="words")


@pytest.mark.parametrize("slice_windows", [1_000_000, 2])
def test_benchmark_items_without_an_id_hit(spark, slice_windows):
    docs = spark.createDataFrame([(1, "the lazy dog sleeps here"), (2, "a quick brown fox"), (3, "nothing at all")], "doc_id long, text string")
    windows = decontamination.benchmark_windows(spark.createDataFrame([(None, "lazy dog"), (None, "fox"), (7, "quick brown"), (8, "none of these")], "item_id long, text string"))
    found = decontamination.digest(decontamination.find_contamination(docs, windows, slice_windows=slice_windows))
    assert sorted((r.doc_id, r.n_hit, r.n_items, r.contaminated) for r in found.collect()) == [(1, 2, 0, True), (2, 3, 1, True), (3, 0, 0, False)]
    assert frames.ids(decontamination.decontaminate(docs, windows, slice_windows=slice_windows)) == [3]


def test_packing(spark, docs):
    rows = best_fit_packing.pack(best_fit_packing.token_pieces(docs)).collect()
    assert [r.ids for r in rows if r.doc_id in (1, 2)] == [[2], [2]]
    assert sum(r.doc_id == 7 for r in rows) == 2 and all(r.length == len(r.ids) for r in rows)
    assert best_fit_packing.pack(best_fit_packing.token_pieces(frames.empty(spark))).count() == 0


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(8, 1), (8, 0), (4, 0), (5, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, model)
    assert frames.ids(rows) == frames.ALL_IDS and all(0 <= r.toxicity <= 1 for r in rows.collect())
    taught = toxicity.Model([toxicity.Term("quick", False, 3.0)], bias=0.0)
    assert toxicity.score(docs, taught, keep=["doc_id"]).columns == ["doc_id", "toxicity"]
    assert toxicity.score(frames.empty(spark), toxicity.learn(frames.empty(spark), labels.where("false"))).count() == 0


def test_language(spark, docs):
    filters = language_id.learn(docs)
    rows = {r.doc_id: r.language for r in language_id.predict(docs, filters, keep=["doc_id"]).collect()}
    assert rows[1].lang == rows[2].lang == rows[3].lang == "und" and rows[1].score == 0
    assert rows[7].lang == "de" and rows[8].lang == "en" and rows[9].lang == "xx"
    assert frames.ids(language_id.predict(docs, filters)) == frames.ALL_IDS
    unlearned = language_id.learn(frames.empty(spark))
    assert {r.language.lang for r in language_id.predict(docs, unlearned, keep=["doc_id"]).collect()} == {"und"}
    assert language_id.predict(frames.empty(spark), filters).count() == 0
