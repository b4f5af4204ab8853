"""The operators against brute force, exact round trips and held-out rows."""

from __future__ import annotations

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortloom.llm import best_fit_packing, chat_roles, components, decontamination, gru_lm, language_id, ngram_join, queries, recurrent, token_counts, toxicity, vector_sharding
from cohortloom.llm.folds import held_out
from cohortloom.llm.oracles import ORACLES
from cohortloom.llm.textbytes import NOT_SPACE, covered, pieces, run_hashes
from cohortloom.llm.tokens import encoder
from tests import compare
from tests.llm import frames

FOLDER = "/root/testdata/sf0.001"


def documents(spark):
    return queries.table(spark, FOLDER, "documents")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare.difference(queries.QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLES[name]) is None


# Bytes and words


def test_pieces_cover_all_rows():
    texts = ["", "a b", None, "x" * 50, "é  ü\n", "last"] * 7
    got = [p.text(r).decode() for p in pieces(pa.array(texts), 30) for r in range(len(p))]
    assert got == [t or "" for t in texts]


def test_words_runs_and_hashes():
    texts = ["a b c a b", "", "a b", " é\tb  "]
    (piece,) = pieces(pa.array(texts))
    starts, ends, rows = piece.spans(NOT_SPACE)
    words = [piece.data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    assert words == [w for t in texts for w in t.split()] and rows.tolist() == [0] * 5 + [2] * 2 + [3] * 2
    hashes = piece.hashes(starts, ends)
    assert all((words[i] == words[j]) == (hashes[i] == hashes[j]) for i, j in itertools.product(range(len(words)), repeat=2))
    at, runs = run_hashes(hashes, rows, 2)
    assert at.tolist() == [0, 1, 2, 3, 5, 7] and runs[0] == runs[3] == runs[4] != runs[1]
    assert covered(np.array([0, 3]), 2, 6).tolist() == [True, True, False, True, True, False]


# 1: n-gram Jaccard join


def _shingles(text):
    words = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def _copies(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 150))]
        for _ in range(rng.randrange(1, 30)):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize(("rows_in_block", "shingles_in_block"), [(512, 1_000_000), (8, 600)])
def test_ngram_join_finds_every_link(spark, monkeypatch, rows_in_block, shingles_in_block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", rows_in_block)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles_in_block)
    rows = _copies()
    sets = {i: _shingles(t) for i, t in rows}
    classes = {}
    for i, s in sets.items():
        classes.setdefault(s, []).append(i)
    links = {i: 0 for i in sets}
    root = {i: min(classes[s]) for i, s in sets.items()}
    for a, b in itertools.combinations(classes, 2):
        if 5 * len(a & b) >= 4 * len(a | b):
            for i in classes[a] + classes[b]:
                links[i] += 1
            low, high = sorted((root[classes[a][0]], root[classes[b][0]]))
            root = {i: low if r == high else r for i, r in root.items()}
    got = {r.doc_id: (r.class_id, r.n_links, r.copy_of, r.n_copies) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (root[i], links[i], min(classes[s]), len(classes[s])) for i, s in sets.items()}
    assert max(links.values()) > 5


def test_posterior_bounds():
    need = ngram_join.least_matches(0.8, 1e-9)
    assert sorted(need) == [16, 32, 48, 64] and all(0 < m < 0.8 * n for n, m in need.items())
    draws = np.random.default_rng(0).binomial(64, 0.8, 200_000)
    assert (draws < need[64]).mean() < 1e-4


def test_components_of_paths_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3), (200, 150)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 150: 150, 200: 150}


# 2 and 8: tokens


def _texts():
    odd = ["it's 'odd'  don't", "  two   spaces \n\n x", "12 345 6a7 $%& &\n", "a  b 　 c", "  d  e", "foo  <|endoftext|>bar <|endoftext|> x", "日本語 テキスト 。 ok", "y" * 3000 + " z", " " * 3000 + "q", "\x1c y\x1d z\x85 w"]
    return odd + [r[1] for r in frames.EDGE_ROWS if r[1]]


def test_token_ids_are_those_of_the_tokenizer(spark):
    encode = encoder("byte_bpe_50k.json")
    texts = _texts() + [r.text for r in documents(spark).collect()]
    got = [ids.tolist() for p in pieces(pa.array(texts)) for ids in encode.rows(p)]
    assert got == [encode.exact.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_counts_against_offsets(spark):
    encode = encoder("byte_bpe_50k.json")
    texts = [t for t in _texts() if t.isascii() and len(t) < 2000] + ["a\nb\n\n c d\n", "one two\n three", "x\n\n\n\n\n\n y"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {rule: {} for rule in token_counts.RULES}
    for rule in got:
        for r in token_counts.line_counts(rows, rule=rule).collect():
            got[rule][(r.doc_id, r.section)] = r.n_tokens
    for i, text in enumerate(texts):
        cuts = [m.end() for m in re.finditer("\n", text)]
        ends = cuts if cuts and cuts[-1] == len(text) else [*cuts, len(text)]
        spans = list(zip([0, *ends[:-1]], ends, strict=True))
        want = {rule: [0.0] * len(spans) for rule in got}
        for a, b in encode.exact.encode(text, add_special_tokens=False).offsets:
            held = [max(0, min(b, y) - max(a, x)) for x, y in spans]
            want["first"][next(s for s, h in enumerate(held) if h)] += 1
            want["most"][held.index(max(held))] += 1
            for s, h in enumerate(held):
                want["split"][s] += h / sum(held)
        for rule in got:
            assert [got[rule][(i, s)] for s in range(len(spans))] == pytest.approx(want[rule])


def test_packing_keeps_every_id(spark):
    docs = documents(spark).unionByName(documents(spark).limit(5))
    rows = best_fit_packing.pack(best_fit_packing.token_pieces(docs)).collect()
    encode = encoder("byte_bpe_50k.json")
    want = sorted([r.doc_id, *encode.exact.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect())
    by_sequence, by_piece = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.length == 1024 or r.piece == 0
        by_piece.setdefault((r.doc_id, r.start, r.piece, tuple(r.ids)), []).append(r)
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    once = {}
    for (doc, start, _, ids), copies in by_piece.items():
        once.setdefault(doc, []).append((start, ids, len(copies)))
    again = sorted([doc, *(t for _, ids, _ in sorted(own) for t in ids)] for doc, own in once.items() for _ in range(own[0][2]))
    assert again == want
    least = -(-sum(len(w) - 1 for w in want) // 1024)
    assert least <= len(by_sequence) <= 1.03 * least + 2


@pytest.mark.parametrize("seed", range(4))
def test_packing_plans(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(1024, rng.lognormal([5, 6, 6.5, 4][seed], [1, 0.5, 0.2, 1.5][seed], 20_000).astype(int) + 1)
    histogram = dict(enumerate(np.bincount(lengths).tolist()))
    runs = best_fit_packing.plan_packing(histogram)
    held = np.zeros(1025, int)
    for run in runs:
        assert sum(x * n for x, n in run.items) + run.room == 1024 and run.room >= 0
        for x, n in run.items:
            held[x] += n * run.count
    assert held.tolist() == np.bincount(lengths, minlength=1025).tolist()
    first_fit = []
    for x in sorted(lengths.tolist(), reverse=True)[:4000]:  # a plain packing of the longest, as a bound
        room = next((i for i, r in enumerate(first_fit) if r >= x), None)
        if room is None:
            first_fit.append(1024 - x)
        else:
            first_fit[room] -= x
    longest = dict(enumerate(np.bincount(np.sort(lengths)[::-1][:4000]).tolist()))
    assert sum(r.count for r in best_fit_packing.plan_packing(longest)) <= 1.02 * len(first_fit) + 2


# 3: language model


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    docs = [rng.integers(1, 256, rng.integers(1, 40)).astype(np.int16) for _ in range(12)]
    flat = recurrent.initial(np.bincount(np.concatenate(docs), minlength=256) + 1).astype(np.float64)
    window, state = next(recurrent.lanes(docs)), np.zeros((recurrent.LANES, recurrent.WIDTH), np.float32)
    g, _, _ = recurrent.gradient(recurrent.unpack(flat), window, state)
    for i in np.argsort(-np.abs(g))[:400:40]:
        moved = [flat.copy(), flat.copy()]
        moved[0][i] += 1e-2
        moved[1][i] -= 1e-2
        up, down = (recurrent.gradient(recurrent.unpack(m), window, state)[2] for m in moved)
        assert (up - down) / 2e-2 == pytest.approx(g[i], rel=0.05, abs=1e-5)


def test_score_carries_state_over_windows():
    rng = np.random.default_rng(2)
    docs = [rng.integers(1, 256, n).astype(np.int16) for n in (0, 1, 31, 32, 33, 200, 700)]
    w = recurrent.unpack(recurrent.initial(np.ones(256)))
    together, alone = recurrent.score(w, docs), [recurrent.score(w, [d])[0] for d in docs]
    assert together == pytest.approx(alone, rel=1e-4)
    # Word by word, without lanes or windows.
    for doc, want in zip(docs[:5], alone, strict=False):
        h, total = np.zeros(recurrent.WIDTH), 0.0
        for given, wanted in zip([0, *doc], [*doc, 0], strict=True):
            x = w["embed"][given] @ w["into"] + w["bias"]
            back, n = h @ w["back"], recurrent.WIDTH
            z, r = (1 / (1 + np.exp(-(x[s] + back[s]))) for s in (slice(0, n), slice(n, 2 * n)))
            fresh = np.tanh(x[2 * n :] + r * back[2 * n :])
            h = z * h + (1 - z) * fresh
            c, u = divmod(int(wanted), recurrent.CLASSES)
            for logits, pick in ((h @ w["class_out"] + w["class_bias"], c), (h @ w["unit_out"][c] + w["unit_bias"][c], u)):
                total += logits[pick] - np.log(np.exp(logits).sum())
        assert total == pytest.approx(want, rel=1e-4)


def test_spelling_is_a_distribution():
    events = np.random.default_rng(3).integers(0, 3, gru_lm.SPELLINGS)
    cells = 10.0 ** gru_lm.spelling_model(events).astype(float)
    assert cells[: gru_lm.LOW_CELLS].reshape(-1, 64).sum(1) == pytest.approx(1, abs=1e-4)
    assert cells[gru_lm.LOW_CELLS :].reshape(-1, 4).sum(1) == pytest.approx(1, abs=1e-4)


def test_language_model_base_and_gain(spark):
    folder = "/root/testdata/sf0.01"
    scored = queries.op3_gru_lm(spark, folder).collect()
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, folder, "documents").collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower)), None] for i, t in texts.items()}
    counts, out = {}, {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    for i, own in words.items():
        for w in own if not out[i] else ():
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in scored:
        own = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(own), sum(w in counts for w in own), n)
        assert r.base_score == pytest.approx(sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in own), abs=1e-6)
    # The model spells unknown words; the base charges them one symbol. Where all words are known the model must gain.
    known = [r for r in scored if r.held_out and r.n_known >= 0.95 * r.n_tokens]
    assert known and sum(r.score for r in known) > sum(r.base_score for r in known)


# 4: chat roles


def test_roles_are_recovered_on_held_out_conversations(spark):
    folder = "/root/testdata/sf0.01"
    turns = queries.op4_chat_roles(spark, folder).where("held_out and line = 0")
    truth = queries.table(spark, folder, "conversations").select("conv_id", F.col("turn").alias("position"), F.col("role").alias("truth")).where(held_out("conv_id", 3, 1))
    rows = truth.join(turns, ["conv_id", "position"], "left").collect()
    met = [r for r in rows if r.role]
    assert len(met) > 0.8 * len(rows) and sum(r.role == r.truth for r in met) > 0.9 * len(met)


def test_chunks_do_not_change_the_best_path(spark, monkeypatch):
    raw = queries.raw_transcripts(queries.table(spark, FOLDER, "conversations")).withColumn("conv_id", F.col("conv_id") % 3).withColumn("turn", F.xxhash64("text") % 500)
    lines = chat_roles.lines_of(raw, "conv_id", "turn", "text").cache()
    model = chat_roles.learn(chat_roles.lines_of(queries.raw_transcripts(queries.table(spark, FOLDER, "conversations")), "conv_id", "turn", "text", "role"))

    def found():
        return sorted((r.conv, r.position, r.line, r.role) for r in chat_roles.recover(lines, model).where("not continues").collect())

    whole = found()
    monkeypatch.setattr(chat_roles, "CHUNK", 40)
    assert found() == whole and len(whole) > 30


def test_rendered_turn(spark):
    rows = [(i, t, r, x) for i in range(30) for t, r, x in ((0, "user", "User: What is it?\nTell me."), (1, "assistant", "Assistant: A thing.\nNo more."))]
    raw = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    model = chat_roles.learn(chat_roles.lines_of(raw, "conv_id", "turn", "text", "role"))
    turns = chat_roles.recover(chat_roles.lines_of(raw, "conv_id", "turn", "text"), model)
    assert {r.rendered for r in turns.collect()} == {"<|user|>\nWhat is it?\nTell me.\n<|end|>", "<|assistant|>\nA thing.\nNo more.\n<|end|>"}


# 5: sharding


def test_shards_are_level_and_groups_stay(spark):
    rng = random.Random(4)
    texts = ["hot text " * 20] * 700 + [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 200))) for _ in range(1500)]
    texts += ["a group of four"] * 4
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = vector_sharding.shard(df, shards=8).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    size, words, count, where = np.zeros(8), np.zeros(8), np.zeros(8), {}
    for r in rows:
        text = texts[r.doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text.encode()) + 16, zlib.crc32(text.encode()), "bytes", None)
        size[r.shard] += r.size
        words[r.shard] += r.n_tokens
        count[r.shard] += 1
        where.setdefault(text, set()).add(r.shard)
    for own in (size, words, count):
        assert own.max() / own.mean() < 1.1 and own.min() / own.mean() > 0.9
    assert len(where["a group of four"]) == 1 and len(where[texts[0]]) > 1
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(int(count[s])))


# 7: decontamination


def test_slices_change_nothing(spark):
    windows = decontamination.benchmark_windows(queries.table(spark, FOLDER, "benchmark"))
    whole = decontamination.find_contamination(documents(spark), windows)
    sliced = decontamination.find_contamination(documents(spark), windows, slice_windows=windows.count() // 2)
    assert sorted(map(str, whole.collect())) == sorted(map(str, sliced.collect()))
    clean = decontamination.decontaminate(documents(spark), windows, remove="spans")
    assert decontamination.find_contamination(clean, windows).where("n_hit > 0").count() == 0


# 9: toxicity


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(5)
    terms = [toxicity.Term(t, False, 2.0 + i / 10) for i, t in enumerate(["idiot", "scum", "disgusting", "worthless", "loser"])]
    terms.append(toxicity.Term("grobian", True, 1.5))
    words = ["idiot", "idoit", "id1ot", "iddiot", "diot", "scam", "scum", "disgustng", "dsgstng", "worthles", "loosers", "grobianisch", "grobiaanisch", "grob", "clean", "i"]
    words += ["".join(rng.choice("idotscumlera") for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    (piece,) = pieces(pa.array([" ".join(words)]))
    found = toxicity.words_of(piece)
    match = toxicity.Automaton(terms).run(found.chars, found.starts, found.ends)
    for word, got in zip(words, match.tolist(), strict=True):
        best = -1.0
        for t in terms:
            ways = [word[:n] for n in range(len(word) + 1)] if t.stem else [word]
            edits = min(_distance(t.text, w) for w in ways)
            if edits <= t.edits:
                best = max(best, t.weight * toxicity.EDIT_WORTH[edits])
        mine = -1.0 if got < 0 else terms[got >> 2].weight * toxicity.EDIT_WORTH[got & 3]
        assert mine == pytest.approx(best), word


def test_quotation_is_told_from_abuse():
    automaton = toxicity.Automaton([toxicity.Term("idiot", False, 5.0)])
    (piece,) = pieces(pa.array(['he said "you idiot" and left', "you IDIOT, idi0t", "“idiot”\nidiot", "", "***idiot***"]))
    x = toxicity.features(piece, automaton)
    assert x[0, 0] == 0 and x[0, 2] == 5 and x[1, 0] == 5 and x[1, 1] == 3 and x[1, 4] > 0
    assert x[2, 0] == 5 and x[2, 2] == 5 and not x[3].any() and x[4, 0] == 5


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.op9_toxicity(spark, folder).join(queries.table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert hit > 0.8 * sum(r.toxic for r in rows) and hit > 0.95 * sum(r.predicted for r in rows)


# 10: language


def test_language_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op10_language_id(spark, folder).join(queries.table(spark, folder, "documents"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) > 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_filters_hold_all_their_ngrams():
    rng = np.random.default_rng(6)
    known = {f"l{i:02}": np.unique(rng.integers(0, 1 << 32, 3000, dtype=np.uint32)) for i in range(11)}
    filters = language_id.build(known)
    assert [m.dtype for m in filters.masks] == [np.uint16]
    other = rng.integers(0, 1 << 32, 50_000, dtype=np.uint32)
    for i, (own, wrong) in enumerate(zip(known.values(), filters.holders(other), strict=True)):
        assert list(filters.holders(own))[i].all()
        assert wrong.mean() == pytest.approx(filters.false_rate[i], rel=0.5, abs=0.002)


# The pipeline


def test_pipeline_stages(spark):
    names = ["toxicity", "language_id", "ngram_join", "decontamination", "best_fit_packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    docs = frames.edge(spark).unionByName(documents(spark).selectExpr("doc_id + 1000 AS doc_id", "text", "lang", "source", *frames.CLASHES.values()))
    labels = queries.table(spark, FOLDER, "labels")
    kept = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert kept.columns == docs.columns and labels.count()
    told = corpus_pipeline.keep_known_language(spark, docs, FOLDER)
    gone = set(frames.ids(docs)) - set(frames.ids(told))
    assert told.columns == docs.columns and {1, 2, 3} <= gone and len(gone) < 10
    near = {r.doc_id: r.class_id for r in ngram_join.near_duplicates(docs).collect()}
    one = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert one.columns == docs.columns and set(frames.ids(one)) == {i for i, c in near.items() if i is None or i == c}
    clean = corpus_pipeline.drop_contaminated(spark, docs, FOLDER)
    assert clean.columns == docs.columns and clean.count() < docs.count()


def test_pipeline_rows(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert set(rows.columns) >= {"doc_id", "piece", "sequence_id", "offset"}
    assert set(frames.ids(rows)) <= set(frames.ids(documents(spark))) and rows.select("doc_id").distinct().count() > 100
