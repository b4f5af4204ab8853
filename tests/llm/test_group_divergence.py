"""Divergence of sources beside a dense version in plain Python, and the trees beside the cells they hold."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import group_divergence as g
from tests.llm import frames

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def plain(rows):
    """``rows`` are (text, lang, source)."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= 3)
        groups = defaultdict(Counter)
        for _, source, words in (d for d in docs if d[0] == lang):
            groups[source].update(w for w in words if seen[w] >= 3)
        whole = sum(groups.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for source, own in groups.items():
            pairs = [(sum((p[source][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != source]
            terms = [((p[source][t] - q[t]) ** 2 // q[t], t) for t in own if p[source][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, 200)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def run(df):
    return sorted(tuple(r) for r in g.Divergence(df).report().select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


@pytest.mark.parametrize("seed", [1, 2])
def test_beside_the_plain_version(spark, seed):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["Zürich", "zürich", "ZÜRICH", "日本"]
    weight = 1 / np.arange(1, len(words) + 1)
    rows = [(" ".join(rng.choice(words, int(rng.integers(0, 60)), p=weight / weight.sum())), ["en", "de", None, ""][int(rng.integers(4))], f"s{min(int(rng.integers(14)), 9)}") for _ in range(260)]
    assert run(frame(spark, rows)) == plain(rows)


def test_more_groups_than_a_tile(spark):
    words = ["aa", "bb", "cc", "dd", "ee", "ff"]
    rows = [(" ".join(words[(i * j) % 6] for j in range(1 + i % 7)), "en", f"h{i % 271}") for i in range(900)]
    assert run(frame(spark, rows)) == plain(rows)


def test_edge_rows_and_empty(spark):
    docs = frames.edge(spark).withColumn("row", F.lit(1)).withColumn("term", F.lit(1)).withColumn("p", F.lit(1))
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    assert run(docs) == plain(rows)
    more = docs.unionByName(docs).unionByName(docs)
    assert run(more) == plain(rows * 3)
    assert run(frames.empty(spark)) == []


def test_counts_of_any_size_are_divided_exactly(spark):
    cases = [(0, 0, 1), (10**13, 3 * 10**13 + 7, 10**8), (9 * 10**18, 9 * 10**18 + 5, 12345), (5, 11, 7), (0, 0, 0)]
    df = spark.createDataFrame(cases, "c long, n long, v long").select(g._share(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    assert [r.p for r in df.collect()] == [None if n + v == 0 else 1 + 10**9 * (c + 1) // (n + v) for c, n, v in cases]


def tile(rng, n, rows):
    cell = rng.choice(rows * g.SIDE, n, replace=False)
    return pd.DataFrame({"lang": "en", "tile": 0, "tiles": 1, "block": 0, "r": cell // g.SIDE, "c": cell % g.SIDE, "p": rng.integers(1, 10**9, n), "p0": cell // g.SIDE + 5})


@pytest.mark.parametrize(("n", "m", "rows"), [(1, 1, 256), (300, 500, 20), (4000, 9, 256), (5000, 5000, 40)])
def test_joint_traversal_meets_each_common_term_once(n, m, rows, monkeypatch):
    monkeypatch.setattr(g, "FRONTIER", 1000)
    rng = np.random.default_rng(n)
    one, two = tile(rng, n, rows), tile(rng, m, rows)
    a, b = (g.Tree(*g._tree(t)[["bits", "shares", "zero"]].iloc[0]) for t in (one, two))
    found = sorted((ra, rb, p, q) for rs, ss, x, y in g.joint_leaves(a, b) for ra, rb, p, q in zip(rs, ss, a.shares[x], b.shares[y], strict=True))
    met = one.merge(two, on="c")
    assert found == sorted(zip(met.r_x, met.r_y, met.p_x, met.p_y, strict=True))
    assert all(a.zero[r] == r + 5 for r in one.r) and a.zero[[r for r in range(256) if r not in set(one.r)]].sum() == 0
