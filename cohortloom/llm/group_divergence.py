"""How far the sources of a language diverge in their words: exact, over whole texts.

Terms are runs of letters a-z, A-Z (lower-cased) and characters outside ASCII. A language keeps the V terms found in
at least ``LEAST_DOCUMENTS`` of its documents. A group is a (language, source); its smoothed share of a kept term is
``p = 1 + floor(SCALE * (count + 1) / (N + V))``, N being its count of all kept terms. The divergence of a group with
share p from one with share q is the sum over the kept terms of ``floor((p - q) ** 2 / q)``, in whole numbers.

The matrix of groups by terms is almost empty. Its cells lie in square tiles of ``SIDE`` groups by ``SIDE`` terms,
each a K-squared tree with K = 2: a nibble for each inner node says which quadrants hold anything, and the leaves are
the shares, in the same order. Then, for two groups A and B:

* the quadrants without a cell are uniform: every term there has the zero shares of A and B, and one price;
* a cell of A alone has a price that depends on its count and on B's zero share, so that A's counts are
  priced by their histogram, whatever the terms;
* only cells that both groups hold need the tree: two tiles of the same terms are traversed jointly, quadrant pair by
  quadrant pair, and a pair is left as soon as one side is empty.

The sum is that of all kept terms at the uniform price, plus what the histograms and the joint leaves change in it.

Every partial result is a whole number below 2 ** 63; shares are divided in decimals, so that counts may be of any size.
A task holds one tile of each side; many groups make many tiles, and the pairs of tiles are dealt over tasks.

Defined results: a null text, language or source is an empty one; a row that repeats is a document of its own; a group
without kept terms is at zero everywhere; a language without kept terms has divergence 0 throughout; an empty table has
no rows; columns besides the three are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.joins import join_per_key
from cohortloom.llm.textbytes import Piece, byte_table, pieces
from cohortloom.llm.words import distinct_words
from cohortloom.operators.ranking import global_index, top_k_per_group
from cohortloom.session import scratch_path

LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TERM_RANKS = 200
#: Bits of a tile's side: 2 ** 8 groups by 2 ** 8 terms.
BITS = 8
SIDE = 1 << BITS

LETTERS = byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Cells and bytes of terms that a task gathers before it hands them on.
HELD_CELLS = 400_000
HELD_BYTES = 32 << 20


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# Counting


class _Cells:
    """Counts of (group, term) that grow up to a bound."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.groups.clear()
        self.terms: list[pa.Array] = []
        self.n_terms = self.n_cells = self.n_bytes = 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, piece: Piece, names: list[tuple[str, str]]) -> None:
        own = np.array([self.groups.setdefault(n, len(self.groups)) for n in names], np.int64)
        terms, rows, word = distinct_words(piece.lowered(), LETTERS)
        if not len(terms):
            return
        width = len(terms)
        in_row, count = np.unique(rows * width + word, return_counts=True)
        key, back = np.unique(own[in_row // width] * width + in_row % width, return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, back, count)
        self.parts.append((key // width, key % width + self.n_terms, total, np.bincount(back, minlength=len(key))))
        self.terms.append(terms)
        self.n_terms += width
        self.n_cells += len(key)
        self.n_bytes += terms.nbytes

    def full(self) -> bool:
        return self.n_cells > HELD_CELLS or self.n_bytes > HELD_BYTES

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        coded = pa.concat_arrays(self.terms).dictionary_encode()
        one = coded.indices.to_numpy()
        group, term, count, docs = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        width = len(coded.dictionary)
        key, back = np.unique(group * width + one[term], return_inverse=True)
        total, documents = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        np.add.at(total, back, count)
        np.add.at(documents, back, docs)
        names = list(self.groups)
        for at in range(0, len(key), 50_000):
            part = slice(at, at + 50_000)
            code = pa.array(key[part] // width)
            columns = [pa.array([n[i] for n in names], pa.string()).take(code) for i in (0, 1)]
            texts = coded.dictionary.take(pa.array(key[part] % width)).cast(pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, texts, pa.array(total[part]), pa.array(documents[part])], ["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Cells()
    for batch in batches:
        names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
        for piece in pieces(batch.column("text")):
            held.add(piece, names[piece.first : piece.first + len(piece)])
            if held.full():
                yield from held.rows()
                held.clear()
    yield from held.rows()


def _named(documents: DataFrame, *columns: str) -> DataFrame:
    return documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in zip(columns, ("lang", "source", "text"), strict=False)])


def term_counts(documents: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""
    counted = _named(documents, lang, source, text).mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# Shares


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)) as a long; null without terms."""
    raised = (count.cast("decimal(20,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
    by = F.when(terms > 0, total.cast("decimal(20,0)") + terms)
    return (F.floor((raised - raised % by) / by) + 1).cast("long")


def _price(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


class Divergence:
    """The counted matrix of a table of documents, and the reports on it."""

    def __init__(self, documents: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_documents: int = LEAST_DOCUMENTS):
        counted = _stored(term_counts(documents, lang, source, text), "terms")
        kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("_docs")).where(F.col("_docs") >= least_documents)
        # Frequent terms first: their cells fill the first tiles, and the many rare ones leave the others almost empty.
        ranked = kept.select("lang", "term", "total", (-F.col("total")).alias("_order"))
        columns = _stored(global_index(ranked, ["lang", "_order", "term"], "col", start=0).drop("_order"), "columns")
        cells = _stored(counted.drop("docs").join(columns, ["lang", "term"]), "cells")
        langs = columns.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
        sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
        groups = _named(documents, lang, source).distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["group_n", "v", "lang_n"])
        numbered = global_index(groups, ["lang", "source"], "row", start=0)
        first = numbered.groupBy("lang").agg(F.min("row").alias("_first"), F.max("row").alias("_last"))
        within = numbered.join(first, "lang").withColumn("tile", F.expr(f"(row - _first) div {SIDE}")).withColumn("tiles", F.expr(f"(_last - _first) div {SIDE} + 1"))
        zero = _share(F.lit(0), F.col("group_n"), F.col("v"))
        self.groups = _stored(within.select("lang", "source", "row", ((F.col("row") - F.col("_first")) % SIDE).cast("int").alias("r"), "tile", "tiles", "group_n", "lang_n", "v", zero.alias("p0")), "groups")
        #: One row per cell: its group's numbers, its term's column, and the shares p of the group and q of the language.
        shared = join_per_key(cells, self.groups, ["lang", "source"], self.groups.count())
        p, q = _share(F.col("n"), F.col("group_n"), F.col("v")), _share(F.col("total"), F.col("lang_n"), F.col("v"))
        self.cells = _stored(shared.select("lang", "source", "row", "r", "tile", "tiles", "term", "col", "n", "p0", p.alias("p"), q.alias("q")), "shares")

    def terms(self, ranks: int = TERM_RANKS) -> DataFrame:
        """(lang, source, item, value, rank): the terms that a group uses more than its language does."""
        found = self.cells.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(_price("p", "q")).alias("value"))
        return top_k_per_group(found, ["lang", "source"], [F.desc("value"), F.asc("item")], ranks, rank="rank")

    def trees(self) -> DataFrame:
        """(lang, tile, tiles, block, bits, shares, zero): the K-squared trees of the tiles that hold anything."""
        rows = self.cells.select("lang", "tile", "tiles", F.expr(f"col div {SIDE}").alias("block"), "r", (F.col("col") % SIDE).cast("int").alias("c"), "p", "p0")
        return rows.groupBy("lang", "tile", "block").applyInPandas(_tree, "lang string, tile long, tiles long, block long, bits binary, shares array<long>, zero array<long>")

    def pairs(self) -> DataFrame:
        """(lang, source, item, value, rank): every other source of the language, the most different first."""
        every = F.expr("explode(sequence(0L, tiles - 1))")
        g = self.groups
        one = g.select("lang", F.col("row").alias("a"), "p0", "v", F.col("tile").alias("i"), every.alias("j"))
        two = g.select("lang", F.col("row").alias("b"), F.col("p0").alias("q0"), every.alias("i"), F.col("tile").alias("j"))
        meet = one.join(two, ["lang", "i", "j"]).where("a <> b")
        uniform = meet.select("a", "b", F.expr(f"coalesce(v * {_price('p0', 'q0')}, 0L)").alias("value"))

        # The cells of one group alone: as those of A against B's zero share, and as those of B against A's.
        counts = self.cells.groupBy("lang", "row", "tile", "tiles", "p0", "p").agg(F.count(F.lit(1)).alias("k"))
        held = counts.select("lang", "row", "p", F.col("p0").alias("own"), "k", F.col("tile").alias("i"), every.alias("j"))
        other = two.select("lang", "b", "q0", "i", "j")
        met = held.join(other, ["lang", "i", "j"]).where("row <> b")
        ways = F.array(
            F.struct(F.col("row").alias("a"), F.col("b").alias("b"), F.expr(f"k * ({_price('p', 'q0')} - {_price('own', 'q0')})").alias("value")),
            F.struct(F.col("b").alias("a"), F.col("row").alias("b"), F.expr(f"k * ({_price('q0', 'p')} - {_price('q0', 'own')})").alias("value")),
        )
        alone = met.select(F.explode(ways).alias("w")).select("w.*").groupBy("a", "b").agg(F.sum("value").alias("value"))

        trees = _stored(self.trees(), "trees")
        left = trees.select("lang", "block", F.col("tile").alias("i"), *[F.col(c).alias(f"a_{c}") for c in ("bits", "shares", "zero")])
        right = trees.select("lang", "block", F.col("tile").alias("j"), *[F.col(c).alias(f"b_{c}") for c in ("bits", "shares", "zero")])
        joint = left.join(right, ["lang", "block"]).drop("block").mapInPandas(_joint, "lang string, i long, ra int, j long, rb int, value long")
        summed = joint.groupBy("lang", "i", "ra", "j", "rb").agg(F.sum("value").alias("value"))
        first = g.where("tile = 0 and r = 0").select("lang", F.col("row").alias("_first"))
        at = lambda tile, r: F.col("_first") + F.col(tile) * SIDE + F.col(r)
        both = summed.join(first, "lang").select(at("i", "ra").alias("a"), at("j", "rb").alias("b"), "value").where("a <> b")

        total = uniform.unionByName(alone).unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("value"))
        names, n = g.select("row", "lang", "source"), g.count()
        named = join_per_key(total, names.withColumnRenamed("row", "a"), ["a"], n)
        named = join_per_key(named, names.select(F.col("row").alias("b"), F.col("source").alias("item")), ["b"], n)
        rows = named.select("lang", "source", "item", "value")
        return top_k_per_group(rows, ["lang", "source"], [F.desc("value"), F.asc("item")], (1 << 31) - 2, rank="rank", salts=1)

    def report(self) -> DataFrame:
        """(lang, source, part, item, value, rank), both parts."""
        parts = [rows.withColumn("part", F.lit(name)) for name, rows in (("pair", self.pairs()), ("term", self.terms()))]
        return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


# Trees


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of ``x``, each followed by an empty one."""
    out = np.zeros(len(x), np.int64)
    for bit in range(BITS):
        out |= ((x >> bit) & 1) << (2 * bit)
    return out


def _tree(pdf: pd.DataFrame) -> pd.DataFrame:
    """The tree of one tile: nibbles of the inner nodes, level by level, and the shares of the leaves in their order."""
    r, c = pdf["r"].to_numpy(np.int64), pdf["c"].to_numpy(np.int64)
    code = _spread(r) << 1 | _spread(c)
    order = np.argsort(code)
    code = code[order]
    nibbles = []
    for level in range(BITS):
        child = np.unique(code >> (2 * (BITS - 1 - level)))
        parents, at = np.unique(child >> 2, return_inverse=True)
        bits = np.zeros(len(parents), np.uint8)
        np.bitwise_or.at(bits, at, (1 << (child & 3)).astype(np.uint8))
        nibbles.append(bits)
    zero = np.zeros(SIDE, np.int64)
    zero[r] = pdf["p0"].to_numpy(np.int64)
    first = pdf.iloc[0]
    return pd.DataFrame({"lang": [first["lang"]], "tile": [first["tile"]], "tiles": [first["tiles"]], "block": [first["block"]], "bits": [np.concatenate(nibbles).tobytes()], "shares": [pdf["p"].to_numpy(np.int64)[order]], "zero": [zero]})


class Tree:
    """A K-squared tree, read level by level."""

    def __init__(self, bits: bytes, shares: np.ndarray, zero: np.ndarray):
        self.shares, self.zero = np.asarray(shares, np.int64), np.asarray(zero, np.int64)
        raw, self.levels, at, n = np.frombuffer(bits, np.uint8), [], 0, 1
        for _ in range(BITS):
            has = (raw[at : at + n, None] >> np.arange(4, dtype=np.uint8)) & 1
            # Where each quadrant's node is in the next level; -1 for an empty one.
            number = np.cumsum(has.reshape(-1), dtype=np.int64).reshape(-1, 4) - 1
            self.levels.append(np.where(has, number, -1))
            at, n = at + n, int(has.sum())


#: Pairs of nodes that the joint traversal holds at once.
FRONTIER = 200_000


def joint_leaves(a: Tree, b: Tree) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Leaves of the same term in both trees: (row of a, row of b, leaf of a, leaf of b), a bounded number at a time."""
    none = np.zeros(1, np.int64)
    stack = [(0, none, none, none, none)]
    while stack:
        level, x, y, rx, ry = stack.pop()
        if len(x) > FRONTIER:
            half = len(x) // 2
            stack += [(level, *(v[part] for v in (x, y, rx, ry))) for part in (slice(half), slice(half, None))]
            continue
        if level == BITS:
            yield rx, ry, x, y
            continue
        out = []
        for column in (0, 1):
            for ra in (0, 1):
                for rb in (0, 1):
                    u, v = a.levels[level][x, 2 * ra + column], b.levels[level][y, 2 * rb + column]
                    keep = (u >= 0) & (v >= 0)
                    out.append((u[keep], v[keep], 2 * rx[keep] + ra, 2 * ry[keep] + rb))
        parts = [np.concatenate(c) for c in zip(*out, strict=True)]
        if len(parts[0]):
            stack.append((level + 1, *parts))


def _prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def joint_sums(a: Tree, b: Tree) -> np.ndarray:
    """What the terms that both groups hold change in the sum of the uniform and the one-sided prices."""
    total = np.zeros((SIDE, SIDE), np.int64)
    for ra, rb, x, y in joint_leaves(a, b):
        p, q, p0, q0 = a.shares[x], b.shares[y], a.zero[ra], b.zero[rb]
        np.add.at(total, (ra, rb), _prices(p, q) - _prices(p, q0) - _prices(p0, q) + _prices(p0, q0))
    return total


#: Pairs of tiles whose sums a task holds before it hands them on.
HELD_TILES = 32


def _joint(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[tuple[str, int, int], np.ndarray] = {}

    def rows() -> Iterator[pd.DataFrame]:
        for (lang, i, j), total in held.items():
            ra, rb = np.nonzero(total)
            yield pd.DataFrame({"lang": lang, "i": i, "ra": ra.astype(np.int32), "j": j, "rb": rb.astype(np.int32), "value": total[ra, rb]})
        held.clear()

    for frame in frames:
        for row in frame.itertuples(index=False):
            key = (row.lang, row.i, row.j)
            if key not in held and len(held) >= HELD_TILES:
                yield from rows()
            sums = joint_sums(Tree(row.a_bits, row.a_shares, row.a_zero), Tree(row.b_bits, row.b_shares, row.b_zero))
            held[key] = held[key] + sums if key in held else sums
    yield from rows()
