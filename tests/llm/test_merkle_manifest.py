"""The Merkle manifest beside a version in plain Python, for small superblocks too."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import merkle_manifest as m
from tests.llm import frames

KIND = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def walk(nodes):
    """The top of some nodes, and the siblings and sides of each."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, place, strict=True):
            other = at ^ 1
            path.append(None if other >= len(nodes) else (other < at, nodes[other]))
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        place = [p // 2 for p in place]
    return nodes[0], paths


def plain(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append(row)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    tops, inner = {}, {}
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        tops[name], inner[name] = walk([leaf(r) for r in trees[name]])
    root, outer = walk([tops[n] for n in names])
    out = []
    for place, name in enumerate(names):
        for row, path in zip(trees[name], inner[name], strict=True):
            bad = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf((*row[:3], row[3] + 1, row[4]) if bad else row)
            steps = path + outer[place]
            for step in steps:
                node = h(node) if step is None else h(step[1], node) if step[0] else h(node, step[1])
            out.append((row[0], leaf(row), tops[name], root, h(*[s[1] for s in steps if s]), node, node == root))
    return out


def run(spark, rows, levels):
    df = spark.createDataFrame(rows, KIND)
    found = m.Manifest(m.leaves(df, claim=m.n_chars_tampered()), levels).verify()
    return [tuple(r) for r in found.select(*COLUMNS).collect()]


def some(n, langs):
    return [(i * 3 % (n + 1), f"s{i % 5}", langs[i * i % len(langs)], None if i % 11 == 0 else i, None if i % 13 == 0 else f"text {i} é") for i in range(n)]


@pytest.mark.parametrize(("n", "levels"), [(1, 1), (2, 1), (150, 1), (150, 2), (150, 10)])
def test_beside_the_plain_version(spark, n, levels):
    rows = some(n, ["en", None, "", "de", "Zz", "en", "en"])
    assert Counter(run(spark, rows, levels)) == Counter(plain(rows))


def test_rows_that_repeat_and_ids_that_repeat(spark):
    rows = some(9, ["en"]) + [(7, "s", "en", 1, "same")] * 21 + [(7, "s", "en", 1, f"other {i}") for i in range(9)] + [(None, None, "en", None, None)] * 5
    found = run(spark, rows, 2)
    assert Counter(found) == Counter(plain(rows))
    assert sum(not r[-1] for r in found) == sum(not r[-1] for r in plain(rows)) > 0


def test_many_trees(spark):
    rows = some(90, [f"l{i}" for i in range(41)])
    assert Counter(run(spark, rows, 2)) == Counter(plain(rows))


def test_subroots_and_root(spark):
    rows = some(40, ["en", "de"])
    manifest = m.Manifest(m.leaves(spark.createDataFrame(rows, KIND)), 2)
    expected = plain(rows)
    assert manifest.root() == expected[0][3]
    assert {r.subroot for r in manifest.subroots().collect()} == {r[2] for r in expected}
    assert manifest.verify().where("not verified").count() == 0


def test_any_changed_field_is_found(spark):
    rows = some(30, ["en", "de"])
    shown = m.leaf_of([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.concat("text", F.lit(" "))])
    manifest = m.Manifest(m.leaves(spark.createDataFrame(rows, KIND), claim=F.when(F.col("doc_id") == 9, shown)), 2)
    assert [r.id for r in manifest.verify().where("not verified").collect()] == [9]


def test_edge_rows_and_empty(spark):
    docs = frames.edge(spark).withColumn("n_chars", F.length("text").cast("long")).withColumn("_i", F.lit(1)).withColumn("t", F.lit(1))
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = m.Manifest(m.leaves(docs, claim=m.n_chars_tampered()), 2).verify()
    assert Counter(tuple(r) for r in found.select(*COLUMNS).collect()) == Counter(plain(rows))
    empty = m.Manifest(m.leaves(docs.where("false"), claim=m.n_chars_tampered()))
    assert empty.verify().count() == 0 and empty.root() is None and empty.subroots().count() == 0
