"""Toxicity on rare labels, sharding with repeated ids, host verdicts, many languages, roles from the data: each beside a plain version."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import chat_roles, host_rules, language_id, ngram_join, toxicity, vector_sharding
from cohortloom.llm.oracles import HOST_RULES
from cohortloom.llm.textbytes import pieces
from tests.llm import frames

# Toxicity


@pytest.mark.parametrize("toxic", [10, 100, 300, 1000])
def test_the_fit_ends_where_the_loss_is_least(toxic):
    y = np.zeros(10_000)
    y[:toxic] = 1
    x = np.zeros((10_000, toxicity.FEATURES))
    x[:, 0] = y
    model = toxicity.fit(x, y)
    assert model.score(x[:1])[0] > 0.99 and model.score(x[-1:])[0] < 0.01
    z = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
    w = np.append(model.weights, model.bias)
    slope = z.T @ (model.score(x) - y) + np.append(model.weights, 0)
    assert np.abs(slope).max() < 1e-3 * len(y) and np.isfinite(w).all()


@pytest.mark.parametrize("every", [100, 1000])
def test_rare_toxic_labels_are_learned(spark, every):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8))) for _ in range(2000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(12)) + (f" grobianus {rng.choice(words)}" if i % every == 0 else "")) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % every == 0)) for i in range(8000)], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.learn(docs, labels, most_labelled=4000), keep=["doc_id"])
    assert {r.doc_id for r in found.where(F.col("toxicity") >= 0.7).collect()} == set(range(0, 8000, every))


def test_the_bound_holds_for_rows_and_kinds(spark):
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(1000)], "_id long, toxic int")
    taken, raised = toxicity._drawn(labels, 100)
    kinds = Counter(r.toxic for r in taken.collect())
    assert kinds == {1: 30, 0: 70} and raised == pytest.approx(math.log(30 / 70) - math.log(30 / 970))
    taken, raised = toxicity._drawn(labels.withColumn("toxic", 1 - F.col("toxic")), 100)
    assert Counter(r.toxic for r in taken.collect()) == {0: 30, 1: 70}
    assert toxicity._drawn(labels, 5000)[1] == 0.0
    docs = spark.createDataFrame([(1, f"bad text {i}") for i in range(500)] + [(i, "fine words") for i in range(2, 40)], "doc_id long, text string")
    few = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 40)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs, few), keep=["doc_id"]).count() == 538


# Sharding


def _loads(rows, shards):
    size, count = np.zeros(shards), np.zeros(shards)
    for r in rows:
        size[r.shard] += r.size
        count[r.shard] += 1
    return size, count


def test_one_id_with_a_third_of_the_rows_stays_level(spark):
    rng = random.Random(3)
    rows = [(7, "the same text " * 3)] * 400 + [(i + 10, " ".join(f"w{rng.randrange(99)}" for _ in range(12))) for i in range(600)]
    found = vector_sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    for load in _loads(found, 8):
        assert load.max() / load.mean() < 1.1 and load.min() / load.mean() > 0.9
    for s in range(8):
        own = [r.slot for r in found if r.shard == s]
        assert sorted(own) == list(range(len(own)))


def test_groups_that_fit_a_shard_stay_whole(spark):
    rng = random.Random(9)
    texts = [f"group {g} of copies with some words" for g, n in enumerate((70, 60, 45, 45, 30, 9, 9, 2)) for _ in range(n)]
    texts += [" ".join(f"w{rng.randrange(999)}" for _ in range(7)) for _ in range(530)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = vector_sharding.shard(df, shards=8).collect()
    where = defaultdict(set)
    for r in found:
        where[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    for load in _loads(found, 8):
        assert load.max() / load.mean() < 1.1


@pytest.mark.parametrize("must_fit", [True, False])
def test_placing_against_plain_loops(must_fit):
    rng = np.random.default_rng(4)
    items = rng.random((60, 3)) * rng.choice([0.002, 0.02, 0.12], (60, 1))
    found = vector_sharding.place(items, 6, must_fit=must_fit).tolist()
    room, expected = [[1 / 6] * 3 for _ in range(6)], [None] * 60
    for i in sorted(range(60), key=lambda i: -max(items[i])):
        fits = [s for s in range(6) if all(room[s][k] >= items[i][k] - 1e-12 for k in range(3))]
        if must_fit and not fits:
            expected[i] = -1
            continue
        best = max(fits or range(6), key=lambda s: (sum(room[s][k] * items[i][k] for k in range(3)), -s))
        room[best] = [room[best][k] - items[i][k] for k in range(3)]
        expected[i] = best
    assert found == expected and (-1 in expected) == must_fit


# Host rules


def _by_sql(rows):
    con = duckdb.connect()
    table = pa.table({c: pa.array([r[i] for r in rows], k) for i, (c, k) in enumerate((("doc_id", pa.int64()), ("text", pa.string()), ("source", pa.string())))})
    con.register("documents", table)
    return sorted(con.execute(HOST_RULES).fetchall(), key=repr)


def test_condemned_doubted_small_and_null_hosts(spark):
    good, noisy, symbols = "one two three four five six seven eight nine ten eleven twelve", "word " * 40, "some words here and there with others #### $$$$ #### that follow on"
    border = "some words here and there with others ## ## that follow on for long"
    rows = []
    for host, bad, fine in (("bad", 60, 10), ("odd", 24, 60), (None, 9, 3), ("tiny", 1, 0), *((f"good{i}", 2, 70) for i in range(12))):
        rows += [(host, noisy if i % 8 == 1 else symbols) for i in range(bad)] + [(host, good) for _ in range(fine)] + [(host, border)]
    rows = [(i, text, host) for i, (host, text) in enumerate(rows)] + [(None, None, "good1"), (3, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    judged = host_rules.judge(df)
    digest = host_rules.digest(judged)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted((tuple(r) for r in digest.select(*names).collect()), key=repr) == _by_sql(rows)
    flags = {r.host: (r.condemned, r.s) for r in judged.groupBy("host").agg(F.max("condemned").alias("condemned"), F.max("doubts_symbols").alias("s")).collect()}
    assert flags["good1"] == (False, False) and flags["odd"] == (False, True) and flags["bad"][0]
    kept = {r.host: r.kept for r in judged.join(df.where(F.col("text") == border).select("doc_id"), "doc_id").select("host", "kept").collect()}
    assert kept["good1"] and not kept["odd"]


# Languages


def test_a_hundred_and_thirty_languages(spark):
    rng = random.Random(2)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{i:03}": ["".join(rng.choice(alphabet) for _ in range(6)) for _ in range(12)] for i in range(130)}
    rows = [(f"{lang}-{j}", " ".join(rng.choice(words) for _ in range(15)), lang) for lang, words in own.items() for j in range(4)]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    filters = language_id.learn(df.where(~F.col("doc_id").endswith("3")))
    assert len(filters.masks) == 3 and len(filters.languages) == 130
    found = language_id.predict(df.where(F.col("doc_id").endswith("3")), filters).collect()
    assert len(found) == 130 and all(r.language.lang == r.lang for r in found)


def test_filters_beside_sets():
    """The same decision with exact sets in place of filters, where no false positive occurs."""
    rng = random.Random(5)
    words = {lang: ["".join(rng.choice("abcdefghij" if lang == "a" else "fghijklmno") for _ in range(5)) for _ in range(30)] for lang in ("a", "b", "c")}
    texts = [" ".join(rng.choice(words[lang]) for _ in range(20)) for lang in ("a", "b", "c") * 10]
    known = {}
    for lang in words:
        for piece in pieces(pa.array([" ".join(words[lang])])):
            known[lang] = np.unique(language_id.grams(piece)[1])
    filters = language_id.build(known)
    for piece in pieces(pa.array(texts)):
        langs, scores = language_id.classify(piece, filters)
        at, codes = language_id.grams(piece)
        row = np.searchsorted(piece.bounds, at, "right") - 1
        for r, text_lang in enumerate(langs):
            held = [[lang for lang in known if c in set(known[lang].tolist())] for c in codes[row == r].tolist()]
            weight = {lang: sum(1 / len(h) for h in held if lang in h) for lang in known}
            assert text_lang == max(weight, key=lambda x: (weight[x], x == text_lang))
            assert scores[r] == pytest.approx(weight[text_lang] / sum(weight.values()), abs=0.02)


# Chat roles


def _turns(rows, spark, model=None):
    raw = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    model = model or chat_roles.learn(chat_roles.lines_of(raw, "conv_id", "turn", "text", "role"))
    found = chat_roles.recover(chat_roles.lines_of(raw, "conv_id", "turn", "text"), model).collect()
    return model, sorted((r.conv, r.position, r.line, r.role, r.rendered) for r in found)


def test_roles_and_markers_come_from_the_data(spark):
    rows = [(i, t, role, text) for i in range(20) for t, role, text in ((0, "user", "User:\nWhat now?"), (1, "tool", "Tool:{x}"), (2, "assistant", "Assistant:hi see http://a.b/c"))]
    model, found = _turns(rows, spark)
    assert model.roles == ["assistant", "tool", "user"]
    assert {f[4] for f in found} == {"<|user|>\nWhat now?\n<|end|>", "<|tool|>\n{x}\n<|end|>", "<|assistant|>\nhi see http://a.b/c\n<|end|>"}
    assert len(found) == 60


def test_viterbi_beside_all_paths():
    rng = np.random.default_rng(3)
    n = 4
    for _ in range(20):
        step, start = np.log(rng.dirichlet(np.ones(n), n)), np.log(rng.dirichlet(np.ones(n)))
        model = chat_roles.Model(["a", "b"], start, step, np.zeros((n, 1)), {}, np.zeros(n))
        shown = rng.normal(size=(6, n))

        def worth(path, model=model, shown=shown):
            return model.start[path[0]] + sum(shown[i, s] for i, s in enumerate(path)) + sum(model.step[a, b] for a, b in itertools.pairwise(path))

        best = max(itertools.product(range(n), repeat=6), key=worth)
        assert tuple(chat_roles.decode(model, shown, -1, -1)) == best
        parts = [chat_roles._best_paths(model, shown[:2], True), chat_roles._best_paths(model, shown[2:4], False), chat_roles._best_paths(model, shown[4:], False)]
        ends = chat_roles.borders(model, parts)
        assert tuple(s for k, (before, end) in enumerate(ends) for s in chat_roles.decode(model, shown[2 * k : 2 * k + 2], before, end)) == best


def test_a_turn_of_many_lines_and_rows_without_a_position_are_cut(spark, monkeypatch):
    train = [(i, t, role, f"{role.title()}: text {t}\nmore") for i in range(20) for t, role in ((0, "user"), (1, "assistant"))]
    model, _ = _turns(train, spark)
    rows = [(1, 0, None, "User: long\n" + "\n".join(f"line {i:03}" for i in range(300)))] + [(2, None, None, f"Assistant: row {i:03}") for i in range(120)]
    _, whole = _turns(rows, spark, model)
    monkeypatch.setattr(chat_roles, "CHUNK", 50)
    raw = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = chat_roles.lines_of(raw, "conv_id", "turn", "text")
    sizes = chat_roles._chunked(lines).groupBy("conv", "chunk").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 50 and sizes[1] >= 8
    found = chat_roles.recover(lines, model).collect()
    assert sum(r.n_lines for r in found) == 421
    assert sorted((r.conv, r.position or 0, r.line, r.role) for r in found if not r.continues) == sorted((f[0], f[1] or 0, f[2], f[3]) for f in whole)


# Near duplicates: groups alone


@pytest.mark.parametrize("rows_in_block", [512, 6])
def test_groups_alone_are_those_of_the_links(spark, monkeypatch, rows_in_block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", rows_in_block)
    rng = random.Random(7)
    base = [[f"w{rng.randrange(500)}" for _ in range(60)] for _ in range(6)]
    rows = []
    for i in range(90):
        words = list(base[i % 6])
        if i > 5:
            words[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = {r.doc_id: r.class_id for r in ngram_join.near_duplicates(df).collect()}
    assert sorted(frames.ids(ngram_join.one_of_each(df))) == sorted(set(classes.values()))
    assert len(set(classes.values())) < 60
