"""N-gram Jaccard join with Bayesian candidate pruning.

Words are lower-cased runs of digits, letters a-z and characters outside ASCII; a shingle is five
consecutive words, or all of them in a shorter text. Texts with equal shingle sets form one class of
copies. Classes whose MinHash signatures agree in a band are candidates: their values are compared
step by step, and a pair is dropped as soon as the posterior probability that its similarity
reaches the threshold falls below ``TOLERANCE`` (uniform prior). The others are verified exactly on
their shingle sets.

Two passes keep the work linear where it can be. The first prunes candidates within a bucket on
signatures alone and hands on a forest that spans the surviving pairs, never the pairs. The second
brings the shingle sets of each tree together once, prunes and verifies every pair of it, and hands on
link counts and a forest of the verified links. Buckets and trees beyond a bounded block are
cut into blocks, and each two blocks meet in a task of their own, so no group is ever in one task.
At similarity 0.8 a pair misses all bands with probability 3e-7.

Defined results: a text without words links to nothing and its copies are the texts equal to it; a
null text stands alone (rows of one id together); repeated rows are copies; an empty table gives an
empty result; columns besides the id and the text are never read. Classes, and texts, are told apart
by 64 bits of hash: n of them collide with probability n * n / 2**65.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.llm.components import components, looked_up
from cohortloom.llm.sorted_groups import whole_groups
from cohortloom.llm.textbytes import ALPHANUMERIC, Piece, mix, pieces, run_hashes
from cohortloom.session import scratch_path

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-9
HASHES = 64
BAND_HASHES = 3
BANDS = HASHES // BAND_HASHES
STEP = 16
#: Signatures, and shingles, that a block holds at most.
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1_000_000
#: Rows of a table that may be broadcast (three longs each); beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Copies beyond which a class counts as a hot key.
LEAST_HOT = 100

_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After how many compared values a pair needs how many matches.

    With a uniform prior the posterior of the similarity after m matches in n is Beta(m+1, n-m+1);
    its mass above the threshold is the chance of at most m successes in n+1 trials at the threshold.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def shingle_sets(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of the distinct shingles, sorted by row and hash."""
    low = piece.lowered()
    starts, ends, rows = low.spans(ALPHANUMERIC)
    words = low.hashes(starts, ends)
    at, found = run_hashes(words, rows, SHINGLE_WORDS)
    of = [rows[at]]
    found = [found]
    count = np.bincount(rows, minlength=len(piece))
    for size in range(1, SHINGLE_WORDS):
        mine = count[rows] == size
        if mine.any():
            at, short = run_hashes(words[mine], rows[mine], size)
            of.append(rows[mine][at])
            found.append(short)
    row, shingle = np.concatenate(of), np.concatenate(found)
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    return row[first], shingle[first]


def signatures(shingle: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values (uint32, one line per set); sets begin at ``starts`` and none is empty."""
    out = np.empty((len(starts), HASHES), np.uint32)
    if len(starts):
        product = np.empty_like(shingle)
        high = product.view(np.uint32)[1::2]  # the upper halves, on a little-endian machine
        for i, factor in enumerate(_FACTORS):
            np.multiply(shingle, factor, out=product)
            out[:, i] = np.minimum.reduceat(high, starts)
    return out


def set_keys(shingle: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return mix(np.add.reduceat(mix(shingle + np.uint64(1)), starts)) if len(starts) else np.empty(0, np.uint64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, h, k, n, signature) of each text; without words the key is that of the text, or of the id."""
    for batch in batches:
        lone = batch.column("lone").to_numpy(zero_copy_only=False)
        null = np.array(batch.column("text").is_null())
        for piece in pieces(batch.column("text")):
            n = len(piece)
            row, shingle = shingle_sets(piece)
            count = np.bincount(row, minlength=n)
            full = np.flatnonzero(count)
            starts = np.concatenate([[0], np.cumsum(count[full])[:-1]]).astype(np.int64) if len(full) else np.empty(0, np.int64)
            key = mix(piece.hashes(piece.bounds[:-1], piece.bounds[1:]) + np.uint64(7)) if len(piece.data) else np.full(n, 7, np.uint64)
            own = slice(piece.first, piece.first + n)
            empty = np.diff(piece.bounds) == 0
            key[empty] = np.uint64(7)
            key[null[own]] = mix(lone[own][null[own]].astype(np.int64).view(np.uint64) + np.uint64(11))
            key[full] = set_keys(shingle, starts)
            lines = signatures(shingle, starts)
            raw: list[bytes | None] = [None] * n
            for r, line in zip(full.tolist(), lines, strict=True):
                raw[r] = line.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(piece.first, n), batch.column("h").slice(piece.first, n), pa.array(key.view(np.int64)), pa.array(count.astype(np.int64)), pa.array(raw, pa.binary())],
                ["doc_id", "h", "k", "n", "signature"],
            )


def _lines(column: pa.Array) -> np.ndarray:
    """Signatures of a binary column without nulls."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = _lines(batch.column("signature")).astype(np.uint64)
        k = np.array(batch.column("k"))
        totals = []
        for band in range(BANDS):
            total = np.full(len(k), band + 1, np.uint64)
            for i in range(band * BAND_HASHES, (band + 1) * BAND_HASHES):
                total = mix(total * np.uint64(0x100000001B3) + lines[:, i])
            totals.append(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(totals).view(np.int64)), pa.array(np.tile(k, BANDS))], ["bucket", "k"])


def _pairs(starts: np.ndarray, side: np.ndarray, across: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each group, in bounded portions; in a group of two blocks only pairs across them."""
    size = np.diff(starts)
    end = np.repeat(starts[1:], size)
    row = np.arange(starts[-1])
    after = end - row - 1
    total = np.concatenate([[0], np.cumsum(after)])
    cross = np.repeat(across, size)
    a = 0
    while a < len(row):
        b = max(a + 1, int(np.searchsorted(total, total[a] + most, "right")) - 1)
        own = after[a:b]
        left = np.repeat(row[a:b], own)
        right = left + 1 + (np.arange(len(left)) - np.repeat(total[a:b] - total[a], own))
        good = ~cross[left] | (side[left] != side[right])
        yield left[good], right[good]
        a = b


def _survivors(lines: np.ndarray, left: np.ndarray, right: np.ndarray, need: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that the posterior leaves after each step of the signature."""
    matches = np.zeros(len(left), np.int64)
    for n, least in need.items():
        own = slice(n - STEP, n)
        matches = matches + (lines[left, own] == lines[right, own]).sum(1)
        good = matches >= least
        left, right, matches = left[good], right[good], matches[good]
    return left, right


class _Forest:
    """Labels of rows under unions; a label is the smallest row of its tree."""

    def __init__(self, rows: int):
        self.label = np.arange(rows)

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            a, b = self.label[left], self.label[right]
            low, high = np.minimum(a, b), np.maximum(a, b)
            if (low == high).all():
                return
            np.minimum.at(self.label, high, low)
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]

    def edges(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero(self.label != np.arange(len(self.label)))
        return k[rows], k[self.label[rows]]


def _bucket_edges(need: dict[int, int]) -> Callable:
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["bucket", "i", "j"], 20_000):
            lines = _lines(table["signature"])
            across = (np.array(table["i"]) != np.array(table["j"]))[starts[:-1]]
            forest = _Forest(len(table))
            for left, right in _pairs(starts, np.array(table["side"]), across):
                forest.join(*_survivors(lines, left, right, need))
            a, b = forest.edges(np.array(table["k"]))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return prune


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, parts, k, signature, shingles) for the texts whose key is the expected one, once in a task."""
    seen: set[int] = set()
    for batch in batches:
        keys = batch.column("k").to_pylist()
        fresh = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
        if not fresh:
            continue
        batch = batch if len(fresh) == len(keys) else batch.take(pa.array(fresh))
        expected = np.array(batch.column("k"))
        for piece in pieces(batch.column("text")):
            n = len(piece)
            row, shingle = shingle_sets(piece)
            edge = np.searchsorted(row, np.arange(n + 1))
            full = np.flatnonzero(np.diff(edge))
            key = set_keys(shingle, edge[full]).view(np.int64)
            same = key == expected[piece.first + full]
            full = full[same]
            if not len(full):
                continue
            lines = signatures(shingle, edge[:-1][np.diff(edge) > 0])[same]
            own = batch.take(pa.array(piece.first + full))
            sets = pa.array([shingle[edge[r] : edge[r + 1]].tobytes() for r in full.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [own.column("tree"), own.column("parts"), own.column("k"), pa.array([x.tobytes() for x in lines], pa.binary()), sets],
                ["tree", "parts", "k", "signature", "shingles"],
            )


def _verified(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets are as similar as the threshold."""
    out = np.zeros(len(left), bool)
    if not len(left):
        return out
    rows = np.unique(np.concatenate([left, right]))
    sizes = np.array([len(sets[r]) for r in rows])
    _, codes = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
    edge = np.concatenate([[0], np.cumsum(sizes)])
    place = np.zeros(int(rows[-1]) + 1, np.int64)
    place[rows] = np.arange(len(rows))
    marked = np.zeros(int(codes.max()) + 1, bool)
    order = np.argsort(left, kind="stable")
    turn = np.flatnonzero(np.diff(left[order], prepend=-1))
    for a, b in zip(turn, np.append(turn[1:], len(order)), strict=True):
        one = place[left[order[a]]]
        mine = codes[edge[one] : edge[one + 1]]
        marked[mine] = True
        others = place[right[order[a:b]]]
        shared = np.array([np.count_nonzero(marked[codes[edge[o] : edge[o + 1]]]) for o in others.tolist()])
        out[order[a:b]] = shared >= threshold * (sizes[one] + sizes[others] - shared) - 1e-9
        marked[mine] = False
    return out


def _apart(forest: _Forest, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    good = forest.label[left] != forest.label[right]
    return left[good], right[good]


def _tree_groups(need: dict[int, int], threshold: float) -> Callable:
    """As ``_tree_links`` for the groups alone: a pair that verified links have joined already is not compared.

    The pairs come in portions, those of the first rows first: in a group of near copies the first row links most others,
    and what is left to compare grows with the rows, not with the pairs.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["tree", "i", "j"], 256):
            lines, k = _lines(table["signature"]), np.array(table["k"])
            sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
            across = (np.array(table["i"]) != np.array(table["j"]))[starts[:-1]]
            forest = _Forest(len(table))
            for left, right in _pairs(starts, np.array(table["side"]), across, most=len(table)):
                left, right = _apart(forest, left, right)
                if len(left):
                    left, right = _survivors(lines, left, right, need)
                    good = _verified(sets, left, right, threshold)
                    forest.join(left[good], right[good])
            a, b = forest.edges(k)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "n"])

    return verify


def _tree_links(need: dict[int, int], threshold: float) -> Callable:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["tree", "i", "j"], 256):
            lines, k = _lines(table["signature"]), np.array(table["k"])
            sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
            across = (np.array(table["i"]) != np.array(table["j"]))[starts[:-1]]
            forest, links = _Forest(len(table)), np.zeros(len(table), np.int64)
            for left, right in _pairs(starts, np.array(table["side"]), across):
                left, right = _survivors(lines, left, right, need)
                good = _verified(sets, left, right, threshold)
                left, right = left[good], right[good]
                links += np.bincount(left, minlength=len(k)) + np.bincount(right, minlength=len(k))
                forest.join(left, right)
            a, b = forest.edges(k)
            linked = np.flatnonzero(links)
            none = pa.nulls(len(linked), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(k[linked]), none, pa.array(links[linked])], ["a", "b", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "n"])

    return verify


def _in_blocks(members: DataFrame, group: str) -> DataFrame:
    """Each member once for every two blocks of its group that include its own (column ``parts``), group by group."""
    block = F.pmod(F.xxhash64("k"), F.col("parts"))
    dealt = members.withColumn("_own", block).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = dealt.withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other"), "side": (F.col("_own") > F.col("_other")).cast("int")})
    return dealt.drop("_own", "_other", "parts").repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", "k")


def _text_key(id_col: str, text_col: str) -> Column:
    """Tells texts apart; a null text by the id."""
    text = F.col(text_col).cast("string")
    return F.when(text.isNull(), F.xxhash64(id_col, F.lit(11))).otherwise(F.xxhash64(text))


def _classes(documents: DataFrame, id_col: str, text_col: str, threshold: float, tolerance: float, counted: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, h, k) of all documents, their classes k, and the classes with links (k, root, n_links).

    If not ``counted``, the links are found as far as they join groups, and n_links is null.
    """
    spark = documents.sparkSession
    need = least_matches(threshold, tolerance)

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    text = F.col(text_col).cast("string")
    docs = documents.select(F.col(id_col).alias("doc_id"), _text_key(id_col, text_col).alias("h"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = written(docs.withColumn("lone", F.xxhash64("doc_id")).mapInArrow(_signed, f"doc_id {kind}, h long, k long, n long, signature binary"), "signed")
    nodes = written(base.where("signature is not null").groupBy("k").agg(F.first("n").alias("n"), F.first("signature").alias("signature")), "nodes")

    bands = nodes.select("k", "signature").mapInArrow(_bands, "bucket long, k long")
    parts = F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("long").alias("parts")
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), parts).where("members > 1").drop("members")
    members = bands.join(shared, "bucket").join(nodes.select("k", "signature"), "k")
    trees = components(_in_blocks(members, "bucket").mapInArrow(_bucket_edges(need), "a long, b long"))

    trees = written(trees.join(nodes.select(F.col("k").alias("node"), "n"), "node"), "trees")
    size = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long")
    # The first row of a class: that of the smallest id, a row without an id only where none has one.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h")).alias("first")
    classes = base.groupBy("k").agg(F.min("doc_id").alias("copy_of"), F.count(F.lit(1)).alias("n_copies"), first)
    targets = trees.join(trees.groupBy("root").agg(size.alias("parts")), "root").withColumnRenamed("node", "k")
    targets = targets.join(classes, "k").select("k", F.col("root").alias("tree"), "parts", F.col("first.doc_id").alias("_id"), F.col("first.h").alias("_h"))
    targets = written(targets, "targets")
    few = targets.count() <= BROADCAST_ROWS
    same = (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    met = docs.join(F.broadcast(targets) if few else targets, same).select("tree", "parts", "k", "text")
    # A row that repeats an id and its text would verify itself again: one set per class.
    sets = met.mapInArrow(_with_sets, "tree long, parts long, k long, signature binary, shingles binary").dropDuplicates(["tree", "k"])
    found = written(_in_blocks(sets, "tree").mapInArrow((_tree_links if counted else _tree_groups)(need, threshold), "a long, b long, n long"), "links")

    links = found.where("n is not null").groupBy(F.col("a").alias("k")).agg(F.sum("n").alias("n_links"))
    roots = components(found.where("n is null").select("a", "b")).withColumnRenamed("node", "k")
    return base, classes, written(roots.join(links, "k", "left"), "linked")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, copy_of, n_copies.

    ``copy_of`` is the smallest id among the copies and ``n_copies`` their number; ``n_links`` counts the
    other classes of copies at or above the threshold; ``class_id`` is the smallest id of all that
    links connect. Rows without an id are compared like all others; an id is null only where no row has one.
    """
    base, classes, linked = _classes(documents, id_col, text_col, threshold, tolerance)
    classes = classes.drop("first")
    linked = linked.join(classes.select("k", "copy_of"), "k")
    least = linked.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    linked = linked.join(least, "root").select("k", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    path = scratch_path(documents.sparkSession, "told")
    classes.join(linked, "k", "left").write.parquet(path)
    told = documents.sparkSession.read.parquet(path)
    # Classes of many copies are hot keys; there are few of them, and they meet their documents without a shuffle.
    many = F.col("n_copies") > max(LEAST_HOT, base.count() // BROADCAST_ROWS)
    hot = base.select("doc_id", "k").join(F.broadcast(told.where(many)), "k", "left")
    rest = hot.where("n_copies is null").select("doc_id", "k").join(told.where(~many), "k")
    return hot.where("n_copies is not null").unionByName(rest).select(
        "doc_id",
        F.coalesce("class_id", "copy_of").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "copy_of",
        "n_copies",
    )


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row of each group of texts that links connect, whatever ids repeat or are null. All columns stay.

    The row of the smallest id stays (one without an id only where none has one), of several with that id
    the one of the smallest text hash, and of equal texts the one whose columns come first as JSON.
    """
    spark = documents.sparkSession
    base, classes, linked = _classes(documents, id_col, text_col, threshold, tolerance, counted=False)

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    def few(df: DataFrame, name: str) -> DataFrame:
        found = stored(df, name)
        return F.broadcast(found) if found.count() <= BROADCAST_ROWS else found

    rooted = classes.join(linked.select("k", "root"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("first"), F.sum("n_copies").alias("rows")).where("rows > 1")
    groups = stored(groups.select("root", "first", F.lit(True).alias("shared")), "groups")
    firsts = few(groups.select(F.col("first.doc_id").alias("_id"), F.col("first.h").alias("_h")), "firsts")
    # A group of many classes is a hot key: its one row comes to its classes.
    grouped = looked_up(rooted.select("k", "root"), groups.select("root", "shared"), "root").where("shared")
    texts = few(base.select("k", "h").distinct().join(grouped, "k").select(F.col("h").alias("_h")).distinct(), "one-of-each")
    own = _text_key(id_col, text_col)
    met = documents.join(firsts, (own == F.col("_h")) & F.col(id_col).eqNullSafe(F.col("_id")), "left_semi")
    order = Window.partitionBy(own, id_col).orderBy(F.to_json(F.struct(*documents.columns)))
    place = "_place"
    while place in documents.columns:
        place += "_"
    again = met.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return documents.join(texts, own == F.col("_h"), "left_anti").unionByName(again)
