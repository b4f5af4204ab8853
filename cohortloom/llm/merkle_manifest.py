"""Merkle manifest of a dataset: one tree per partition value, one over their subroots, and a proof per row.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its UTF-8 byte count, a colon and the value. The
leaves of a tree ascend by id (null first), then by hash. While several nodes remain, every two consecutive ones
become the hash of their hex digests; a node left alone is hashed alone. The subroots, in the order of the partition
value (null first, bytewise), make the last tree in the same way.

A superblock is ``2 ** LEVELS`` consecutive nodes. Upwards, each superblock is reduced to its top node, layer after
layer. Downwards, a layer's nodes and the outer nodes that its superblocks need are cogrouped by superblock: one call
finishes the local reduction, joins the local with the outer proof, and folds each claimed leaf along it. No task
holds more than one superblock and one outer path, and rows carry digests only, never texts.

Defined results: an empty table has no rows and no root; a null text or field is ``-``; rows that are equal in all
fields are leaves of their own, next to each other; equal ids are told apart by their leaves; columns that are not
fields are never read, so names cannot clash. A field of another type counts as its string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.joins import join_per_key
from cohortloom.operators.ranking import global_index
from cohortloom.session import scratch_path

LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field_text(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def leaves(documents: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "lang", id_col: str = "doc_id", claim: Column | None = None) -> DataFrame:
    """(tree, id, leaf, claim): ``claim`` is the leaf that a row shows when it is verified, null for its own."""
    own = leaf_of([F.col(c) for c in fields])
    shown = F.lit(None).cast("string") if claim is None else claim
    return documents.select(F.col(tree).cast("string").alias("tree"), F.col(id_col).alias("id"), own.alias("leaf"), shown.alias("claim"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _height(total: int) -> int:
    """Levels between ``total`` nodes and one."""
    return (total - 1).bit_length()


def _above(total: int, levels: int) -> int:
    """Nodes that the next layer has of ``total``."""
    return -(-total // (1 << levels))


def _reduce(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, from the given ones up."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([_sha("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return out


def _steps(levels: list[list[str]], at: int) -> list[str]:
    """The proof of one node inside its superblock: ``L`` or ``R`` and the sibling, or ``S`` where there is none."""
    out = []
    for nodes in levels[:-1]:
        other = at ^ 1
        out.append("S" if other >= len(nodes) else ("L" if other < at else "R") + nodes[other])
        at >>= 1
    return out


def fold(node: str, steps: Sequence[str]) -> str:
    """The root that a node and its proof lead to."""
    for step in steps:
        side, other = step[0], step[1:]
        node = _sha(other + node if side == "L" else node + other)
    return node


def _sorted(pdf: pd.DataFrame, levels: int) -> tuple[pd.DataFrame, list[list[str]]]:
    """A superblock's nodes in order, and the levels above them inside it."""
    pdf = pdf.sort_values("pos")
    return pdf, _reduce(pdf["hash"].tolist(), min(levels, _height(int(pdf["total"].iloc[0]))))


def _block(levels: int) -> Column:
    return F.shiftright("pos", levels).alias("block")


def _upper(nodes: DataFrame, levels: int) -> DataFrame:
    """The next layer: the top node of each superblock."""

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, inner = _sorted(pdf, levels)
        first = pdf.iloc[0]
        return pd.DataFrame({"t": [first["t"]], "pos": [int(first["pos"]) >> levels], "total": [_above(int(first["total"]), levels)], "hash": inner[-1][0]})

    rows = nodes.select("t", _block(levels), "pos", "total", "hash")
    return rows.groupBy("t", "block").applyInPandas(top, "t long, pos long, total long, hash string")


def _proofs(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """(t, pos, hash, path, root, subroot) of a layer's nodes; ``outer`` has (t, pos, path, root, subroot) of its superblocks."""

    def join(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        pdf, inner = _sorted(nodes, levels)
        path = outer["path"].iloc[0].split()
        paths = [" ".join(_steps(inner, i) + path) for i in range(len(pdf))]
        return pd.DataFrame({"t": pdf["t"], "pos": pdf["pos"], "hash": pdf["hash"], "path": paths, "root": outer["root"].iloc[0], "subroot": outer["subroot"].iloc[0]})

    left = nodes.select("t", _block(levels), "pos", "total", "hash").groupBy("t", "block")
    right = outer.select("t", F.col("pos").alias("block"), "path", "root", "subroot").groupBy("t", "block")
    return left.cogroup(right).applyInPandas(join, "t long, pos long, hash string, path string, root string, subroot string")


def _verified(nodes: DataFrame, outer: DataFrame, levels: int, id_type: str) -> DataFrame:
    """The lowest layer: proof digests and folded roots of the claims, superblock by superblock."""

    def finish(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        pdf, inner = _sorted(nodes, levels)
        path, root = outer["path"].iloc[0].split(), outer["root"].iloc[0]
        beyond = "".join(s[1:] for s in path)
        proofs, folded = [], []
        for i, (leaf, claim) in enumerate(zip(pdf["hash"], pdf["claim"], strict=True)):
            steps = _steps(inner, i)
            proofs.append(_sha("".join(s[1:] for s in steps) + beyond))
            folded.append(fold(leaf if claim is None else claim, [*steps, *path]))
        return pd.DataFrame({"id": pdf["id"], "leaf": pdf["hash"], "subroot": outer["subroot"].iloc[0], "root": root, "proof_sha256": proofs, "folded_root": folded})

    left = nodes.select("t", _block(levels), "pos", "total", "hash", F.col("id").cast("string").alias("id"), "claim").groupBy("t", "block")
    right = outer.select("t", F.col("pos").alias("block"), "path", "root", "subroot").groupBy("t", "block")
    found = left.cogroup(right).applyInPandas(finish, "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return found.withColumn("id", F.col("id").cast(id_type)).withColumn("verified", F.col("folded_root") == F.col("root"))


def _layers(nodes: DataFrame, most: int, levels: int, name: str) -> list[DataFrame]:
    """Layers from ``nodes`` up to one node per tree; ``most`` is the size of the largest tree."""
    out = [nodes]
    while True:
        out.append(_stored(_upper(out[-1], levels), name))
        most = _above(most, levels)
        if most <= 1:
            return out


class Manifest:
    """The written layers of a dataset's trees, and what can be asked of them."""

    def __init__(self, leaf_rows: DataFrame, levels: int = LEVELS):
        """``leaf_rows`` are those of ``leaves``; a superblock is ``2 ** levels`` nodes."""
        self.levels = levels
        self.id_type = leaf_rows.schema["id"].dataType.simpleString()
        # Equal rows are spread by their place in the input: a third of all rows may be copies of one.
        stored = _stored(leaf_rows.withColumn("_tie", F.monotonically_increasing_id()), "leaves")
        order = global_index(stored, ["tree", "id", "leaf", "_tie"], "_i", start=0)
        sizes = order.groupBy("tree").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("total"))
        named = F.struct(F.col("tree").isNotNull().alias("known"), F.coalesce("tree", F.lit("")).alias("name"))
        self.trees = _stored(global_index(sizes, ["tree"], "t", start=0), "trees").withColumn("_tree", named)
        size = self.trees.agg(F.count(F.lit(1)), F.max("total")).first()
        self.n_trees, self.largest = size[0], size[1] or 0
        side = self.trees.select("_tree", "t", "_first", "total")
        placed = join_per_key(order.withColumn("_tree", named), side, ["_tree"], self.n_trees)
        self.nodes = _stored(placed.select("t", (F.col("_i") - F.col("_first")).alias("pos"), "total", "id", F.col("leaf").alias("hash"), "claim"), "nodes")
        self.layers = _layers(self.nodes, self.largest, levels, "layer")
        subroots = self.layers[-1].select(F.lit(0).cast("long").alias("t"), F.col("t").alias("pos"), F.lit(self.n_trees).cast("long").alias("total"), "hash")
        self.last = _layers(subroots, self.n_trees, levels, "last")

    def subroots(self) -> DataFrame:
        """(tree, leaves, subroot)."""
        tops = self.layers[-1].select("t", F.col("hash").alias("subroot"))
        return self.trees.join(tops, "t").select("tree", F.col("total").alias("leaves"), "subroot")

    def root(self) -> str | None:
        row = self.last[-1].first()
        return None if row is None else row["hash"]

    def verify(self) -> DataFrame:
        """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row; the claims are folded."""
        outer = self.last[-1].select("t", "pos", F.lit("").alias("path"), F.col("hash").alias("root"), F.lit("").alias("subroot"))
        for nodes in reversed(self.last[:-1]):
            outer = _proofs(nodes, outer, self.levels)
        outer = _stored(outer.select(F.col("pos").alias("t"), F.lit(0).cast("long").alias("pos"), "path", "root", F.col("hash").alias("subroot")), "outer")
        for nodes in reversed(self.layers[1:-1]):
            outer = _stored(_proofs(nodes, outer, self.levels), "outer")
        return _verified(self.nodes, outer, self.levels, self.id_type)


def n_chars_tampered(every: int = 7) -> Column:
    """The leaf of a row whose n_chars is one higher, where ``every`` divides the crc32 of the id; else null."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    values = [more if c == "n_chars" else F.col(c) for c in FIELDS]
    return F.when((F.crc32(F.col("doc_id").cast("string")) % every == 0) & F.col("n_chars").isNotNull(), leaf_of(values))
