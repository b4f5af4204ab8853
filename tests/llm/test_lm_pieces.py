from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cohortloom.llm import gru_lm, queries, recurrent

FOLDER = "/root/testdata/sf0.001"


def _taught(spark):
    docs = queries.table(spark, FOLDER, "documents").select("doc_id", "text")
    alike = spark.range(300).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one row many times").alias("text"))
    nameless = spark.range(20).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") > 3, "no id").alias("text"))
    return docs.unionByName(alike).unionByName(nameless)


def test_weights_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "PIECE_UNITS", 5000)
    docs = _taught(spark)
    counts = gru_lm.word_counts(docs).cache()
    known = gru_lm.vocabulary(counts)
    flat, spelling = gru_lm.train(docs.repartition(1), known, F.xxhash64("doc_id"))
    again, same = gru_lm.train(docs.repartition(7, "text"), known, F.xxhash64("doc_id"))
    assert np.array_equal(flat, again) and np.array_equal(spelling, same)
    assert not np.array_equal(flat, recurrent.initial(known.unit_counts))


def test_every_row_is_dealt_once_and_alike_rows_spread(spark):
    docs = _taught(spark)
    counts = gru_lm.word_counts(docs).cache()
    encoded = gru_lm._encoded(docs, gru_lm.vocabulary(counts), F.xxhash64("doc_id"))
    rows = gru_lm._dealt(encoded, 6).collect()
    assert len(rows) == docs.count() and len({(r.key, r.again) for r in rows}) == len(rows)
    units = sum(len(r.units) // gru_lm.UNIT_KIND.itemsize + 1 for r in rows)
    assert units == gru_lm.vocabulary(counts).tokens
    hot = max({r.key for r in rows}, key=lambda k: sum(r.key == k for r in rows))
    spread = np.bincount([r.piece for r in rows if r.key == hot], minlength=6)
    assert spread.sum() == 300 and spread.max() < 90


def test_weights_are_those_of_the_plain_average(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "PIECE_UNITS", 5000)
    docs = _taught(spark)
    counts = gru_lm.word_counts(docs).cache()
    known = gru_lm.vocabulary(counts)
    part = F.xxhash64("doc_id")
    flat, _ = gru_lm.train(docs, known, part, rounds=1)
    pieces = {}
    most = max(1, round(known.tokens / 5000))
    for r in sorted(gru_lm._dealt(gru_lm._encoded(docs, known, part), most).collect(), key=lambda r: (r.key, r.again)):
        pieces.setdefault(r.piece, []).append(np.frombuffer(bytes(r.units), gru_lm.UNIT_KIND))
    total, units = 0.0, 0
    for held in pieces.values():
        trainer = recurrent.Trainer(recurrent.initial(known.unit_counts))
        trainer.learn(held)
        total, units = total + trainer.flat.astype(float) * trainer.tokens, units + trainer.tokens
    assert most > 1 and np.allclose(flat, total / units, atol=1e-5)
