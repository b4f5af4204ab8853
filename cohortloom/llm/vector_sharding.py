"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Documents of equal text form a group. The few groups that hold over a 64th of a shard of any
resource are placed one by one; all others are dealt by their hash over a fixed number of bundles,
coarse ones with seven eighths of them and fine ones with the rest. Heavy groups, heaviest first, and
then the bundles are placed, each on the shard where the dot product of its vector with the shard's
residual capacity is highest among those it fits. So the plan's size depends on the number of
shards alone, and Spark applies it by a broadcast of that bounded table.

A group stays in one shard as long as any shard has room for it. One that is larger than a shard, or that
none has room for when its turn comes, is cut into parts of a 16th of a shard by a number of the row, not by the id:
rows that repeat an id are dealt like others.

Law: ``bytes``, the shards' sizes are near equal. A size is the UTF-8 bytes of the text plus 16.

Defined results: a null text has size 16 and groups with empty texts; repeated rows each get a slot;
an empty table gives an empty result; other columns are never read, so names cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.numbering import number_within
from cohortloom.session import scratch_path

SHARDS = 40
FIXED_BYTES = 16
#: Bundles per shard, coarse and fine each; a group over one part in so many of a shard is heavy.
BUNDLES = 64
#: A group that fits no shard is cut into parts of one in so many of a shard.
SPLIT_PART = 16
RESOURCES = ("bytes", "tokens", "rows")
WORD = r"[^\x20\x09-\x0D]+"


def documents_with_size(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, n_tokens (words), text_crc32 and the group's key; no text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return documents.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + FIXED_BYTES).alias("size"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("group_key"),
    )


def _sums() -> list:
    return [F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]


def place(items: np.ndarray, shards: int, room: np.ndarray | None = None, must_fit: bool = False) -> np.ndarray:
    """The shard of each item, by the highest dot product with residual capacity, largest items first.

    Items are shares of the whole in each resource; ``room`` is the shards' residual capacity and shrinks. With
    ``must_fit`` an item that no shard has room for gets -1; otherwise it goes where the product is highest.
    """
    room = np.full((shards, items.shape[1]), 1.0 / shards) if room is None else room
    out = np.zeros(len(items), np.int64)
    for i in np.argsort(-items.max(1, initial=0), kind="stable"):
        own = items[i]
        fits = (room >= own - 1e-12).all(1)
        if must_fit and not fits.any():
            out[i] = -1
            continue
        score = room @ own
        if fits.any():
            score = np.where(fits, score, -np.inf)
        best = int(np.argmax(score))
        room[best] -= own
        out[i] = best
    return out


def shard(documents: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, n_tokens, text_crc32, group_key, law, shard, slot, grown_shard (null)."""
    spark = documents.sparkSession
    path = scratch_path(spark, "sizes")
    documents_with_size(documents, id_col, text_col).withColumn("_row", F.xxhash64(F.monotonically_increasing_id())).write.parquet(path)
    base = spark.read.parquet(path)
    totals = base.agg(*_sums()).first()
    limits = {r: (totals[r] or 0) / shards for r in RESOURCES}

    # At most shards * BUNDLES groups can be heavy in each resource.
    groups = base.groupBy("group_key").agg(*_sums())
    is_heavy = F.greatest(*(F.col(r) / F.lit(max(limits[r], 1) / BUNDLES) for r in RESOURCES)) > 1
    heavy = sorted(groups.where(is_heavy).collect(), key=lambda g: bytes(g["group_key"]))
    whole = np.array([max(totals[r] or 0, 1) for r in RESOURCES], float)
    room = np.full((shards, len(RESOURCES)), 1.0 / shards)
    vectors = np.array([[g[r] for r in RESOURCES] for g in heavy], float).reshape(-1, len(RESOURCES)) / whole
    where = place(vectors, shards, room, must_fit=True)
    cuts = [1 if s >= 0 else int(np.ceil(v.max() * shards * SPLIT_PART)) for v, s in zip(vectors, where, strict=True)]
    first = 2 * shards * BUNDLES + np.concatenate([[0], np.cumsum(cuts)]).astype(int)

    key_hash = F.xxhash64("group_key", F.lit(1))
    bundle = F.pmod(F.xxhash64("group_key"), F.lit(shards * BUNDLES)) + F.when(F.pmod(key_hash, F.lit(8)) == 0, shards * BUNDLES).otherwise(0)
    heavies = spark.createDataFrame([(g["group_key"], int(at), n) for g, at, n in zip(heavy, first, cuts, strict=False)], "_key binary, _first long, _parts long")
    part = F.pmod(F.col("_row"), F.col("_parts"))
    marked = base.join(F.broadcast(heavies), F.col("group_key") == F.col("_key"), "left")
    items = marked.withColumn("_item", F.coalesce(F.col("_first") + part, bundle)).drop("_key", "_first", "_parts")

    known = {int(at): int(s) for at, s in zip(first, where, strict=False) if s >= 0}
    weights = [w for w in items.groupBy("_item").agg(*_sums()).collect() if w["_item"] not in known]  # bundles and parts: bounded
    vectors = np.array([[w[r] for r in RESOURCES] for w in weights], float).reshape(-1, len(RESOURCES)) / whole
    known |= {w["_item"]: s for w, s in zip(weights, place(vectors, shards, room).tolist(), strict=True)}
    plan = spark.createDataFrame(sorted(known.items()), "_to long, shard int")
    placed = items.join(F.broadcast(plan), F.col("_item") == F.col("_to")).drop("_item", "_to")
    slotted = number_within(placed, "shard", ["doc_id", "text_crc32"], "slot", F.col("_row"), totals["rows"])
    return slotted.select(*[c for c in base.columns if c != "_row"], F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
