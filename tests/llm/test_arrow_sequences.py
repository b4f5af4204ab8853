"""Arrow sequence files beside the tokenizer itself: ids, places, masks and random access."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm import arrow_sequences as a
from cohortloom.llm.textbytes import pieces
from cohortloom.llm.words import word_encoder
from tests.llm import frames

HARD = [
    "ΣΊΣΥΦΟΣ ὈΔΥΣΣΕΎΣ ΣΑΣ.", "İstanbul I ß ﬁ é é ́alone ạ̈", "don't WE'LL it's 'tis I'd've", "a b c　d​e﻿",
    "<|endoftext|>x <|startoftext|> <|END|>", "日本語のテキスト 한국어 ไทย", "12 345 ½ ²٠", "\x1c\x1d\x85 \x00 tab\tnew\nline\r\v\f", "🙂👨‍👩‍👧 ok", "", " \n", "x" * 3000 + " y",
]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path(a.DEFAULT_FILE))


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_words_alone_give_the_ids_of_the_text(tokenizer):
    encoder = word_encoder(a.DEFAULT_FILE)
    rng = np.random.default_rng(5)
    texts = [*HARD, *[t for t in HARD if len(t) < 2000]]
    texts += ["caféÀ É l'été ÇA “quoted” – x…", "Œuvre ŸǄ ǅ İ ŉ", "naïve's D'MALIN ,'s ''s 's's", "A" * 501, "<|endoftext|>", "a\u0000b \u007f \u001ca"]
    texts += ["".join(chr(c) for c in rng.choice([32, 9, 10, 39, 46, 65, 97, 0x301, 0x3A3, 0x130, 0x1E9E, 0xAC00, 0x1100, 0x1161], 40)) for _ in range(300)]
    for piece in pieces(pa.array(texts)):
        ids, edges = encoder.encode(piece)
        for r in range(len(piece)):
            assert ids[edges[r] : edges[r + 1]].tolist() == whole(tokenizer, texts[piece.first + r])[:-1]


def test_every_token_and_long_texts(tokenizer):
    encoder = word_encoder(a.DEFAULT_FILE)
    texts = ["".join(w) for w in np.array_split(np.array([f"{t.removesuffix('</w>')}{' ' if t.endswith('</w>') else ''}" for t in sorted(tokenizer.get_vocab())], object), 50)]
    rng = np.random.default_rng(2)
    texts += [" ".join("".join(rng.choice(list("etaoinshrdlu'-,.E"), int(n))) for n in rng.integers(1, 14, 20000))]
    for piece in pieces(pa.array(texts)):
        ids, edges = encoder.encode(piece)
        for r in range(len(piece)):
            assert ids[edges[r] : edges[r + 1]].tolist() == whole(tokenizer, texts[piece.first + r])[:-1]


def test_a_file_that_keeps_white_space_is_refused():
    with pytest.raises(ValueError):
        word_encoder("byte_bpe_50k.json")


def expected(tokenizer, rows):
    at, out = 0, []
    for doc_id, text in rows:
        ids = whole(tokenizer, text)
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize(("length", "shards"), [(8, 1), (16, 5), (2048, None)])
def test_documents_come_back(spark, tokenizer, tmp_path, length, shards):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted((tuple(r) for r in docs.collect()), key=lambda r: r[0])[:90]
    df = spark.createDataFrame(rows, "doc_id long, text string").orderBy(F.rand(3))
    files = a.write_sequences(df, str(tmp_path / "out"), length=length, shards=shards)
    assert sorted(tuple(r) for r in files.documents().collect()) == expected(tokenizer, rows)


def test_equal_length_sequences_and_masks(spark, tokenizer, tmp_path):
    rows = [(i, HARD[i % len(HARD)]) for i in range(40)]
    files = a.write_sequences(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "out"), length=8, shards=3)
    stream = [t for _, text in rows for t in whole(tokenizer, text)]
    shards = files.manifest.orderBy("shard").collect()
    assert [r.start for r in shards] == np.concatenate([[0], np.cumsum([r.n_ids for r in shards])[:-1]]).tolist()
    read, arrays = [], {(r.shard, r.sequence): (r.ids, r["mask"]) for r in files.sequences().collect()}
    for shard in shards:
        file = a.SequenceFile(shard.file)
        assert len(file) == shard.n_sequences == -(-shard.n_ids // 8)
        for i in range(len(file)):
            ids, mask = file[i][0], a.unpacked(file[i][1])
            assert ids.shape == mask.shape == (8,) and ids.dtype == np.uint16
            assert arrays[shard.shard, i] == (ids.tolist(), mask.tolist())
            read += ids[mask].tolist()
            assert not ids[~mask].any() and (i + 1 == len(file) or mask.all())
        with pytest.raises(IndexError):
            file[len(file)]
    assert read == stream


def test_access_makes_no_copy(spark, tmp_path):
    rows = [(i, "some words " * 300) for i in range(30)]
    files = a.write_sequences(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "out"), length=16, shards=1)
    before = pa.total_allocated_bytes()
    file = a.SequenceFile(files.manifest.first().file)
    kept = [file[i] for i in range(len(file))]
    assert len(kept) > 1000 and pa.total_allocated_bytes() - before < 10_000
    for view in kept[0]:
        assert not view.flags.owndata and not view.flags.writeable


def test_lengths_are_whole_bytes_and_large_vocabularies_take_four():
    with pytest.raises(ValueError):
        a.sequence_schema(7, 100)
    assert a.sequence_schema(8, 1 << 16).field("ids").type == pa.list_(pa.uint32(), 8)


def test_edges_repeats_and_empty(spark, tokenizer, tmp_path):
    docs = frames.edge(spark)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    files = a.write_sequences(docs, str(tmp_path / "edge"), length=32, shards=4)
    found = sorted((tuple(r) for r in files.documents().collect()), key=lambda r: r[1])
    assert found == expected(tokenizer, rows)
    empty = a.write_sequences(frames.empty(spark), str(tmp_path / "empty"))
    assert empty.documents().count() == 0 and empty.manifest.count() == 0 and empty.sequences().count() == 0
    hot = spark.createDataFrame([(5, "one two")] * 300 + [(i, "three") for i in range(9)], "doc_id long, text string")
    files = a.write_sequences(hot, str(tmp_path / "hot"), length=8, shards=6)
    assert files.manifest.agg(F.max("n_documents")).first()[0] < 120
    assert sorted(r.start for r in files.documents().collect()) == sorted(r[1] for r in expected(tokenizer, sorted((r.doc_id, r.text) for r in hot.collect())))
