"""Language-model scores of whole documents by a gated recurrent model (``recurrent``).

Words are runs of characters other than space and 0x09-0x0D, lower-cased A-Z; a document is its
words and one end. The model predicts units: the most frequent words, and groups of all other words
by their last two bytes. A word of a group then has the probability that mixes its share of the
group in the corpus with a spelling model, which runs backwards from those two bytes; the part of
the spelling model is the share of words seen once (Good-Turing). So every text has a probability
and the probabilities of all texts add up to one.

Spark does the rest: words are counted over all training documents, which a hash deals over pieces of
bounded size. Each piece is learned from common weights, and the weights are averaged, ``ROUNDS`` times
on disjoint pieces that together are all training documents; the table's partitions play no part. In scoring, the counts of the
``MOST_HOT`` most frequent words go to the tasks, and the counts of all others are joined.

Defined results: a null or empty text is an end alone; repeated rows are scored each time; without
training documents the units are equally likely to the model and nothing is known; an empty table gives an
empty result; other columns are never read. Words are told apart by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm import recurrent
from cohortloom.llm.textbytes import NOT_SPACE, Piece, pieces
from cohortloom.session import scratch_path

END_HASH = np.uint64(0x0E0D)
PAIR_GROUPS = 63
#: Unit 0 is the end, units 1 to 64 are groups (the first one of all rare pairs), the others are words.
FIRST_WORD = 2 + PAIR_GROUPS
MOST_HOT = 200_000
ROUNDS = 4
#: Units of text that a task scores at once.
BATCH_UNITS = 3_000_000
#: Units that one training piece is meant to hold, whatever the table's partitions, and tasks of a round at most.
PIECE_UNITS = 1_250_000
MOST_TASKS = 20_000
#: Of the first round; later rounds take smaller steps, as the average of few pieces is the noisier.
RATE = 0.01
#: Weights are summed as whole multiples of its inverse, which a sum in any order leaves the same.
STEPS_OF_ONE = 1 << 24
UNIT_KIND = np.dtype("<i2")
ENCODED = ["key", "units", "cell", "n"]
BLANK = 0x20
#: Spelling: a byte's low six bits, given the low five of the three bytes that follow; then its high two bits,
#: given the low six and the next byte. The counts of both are kept in one array.
CONTEXTS = 1 << 15
LOW_CELLS = CONTEXTS * 64
SPELLINGS = LOW_CELLS + 64 * 32 * 4
#: Weight, in events, of the distribution with one byte less of context.
BACKOFF = 4.0


@dataclass
class Tokens:
    """Words of a piece: places and rows, and of the distinct ones an example, hash, last two bytes and number."""

    low: Piece
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    distinct: np.ndarray  # of each word, which distinct word it is
    example: np.ndarray
    hashes: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def tokens_of(piece: Piece) -> Tokens:
    low = piece.lowered()
    starts, ends, rows = low.spans(NOT_SPACE)
    hashes, example, distinct, times = np.unique(low.hashes(starts, ends), return_index=True, return_inverse=True, return_counts=True)
    if len(example):
        first, last = starts[example], ends[example]
        before = np.where(last - first > 1, low.data[np.maximum(last - 2, 0)], BLANK).astype(np.int64)
        pairs = before * 256 + low.data[last - 1]
    else:
        pairs = np.empty(0, np.int64)
    return Tokens(low, starts, ends, rows, distinct, example, hashes, pairs, times)


def spelling_events(t: Tokens, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two cells of the spelling counts for each byte of the chosen distinct words before their last two, and for
    the blank before it."""
    data = t.low.data
    which = t.example[which]
    n = t.ends[which] - t.starts[which]
    long = which[n > 1]
    size = n[n > 1] - 1  # bytes before the pair, and the blank
    at = np.repeat(t.starts[long] - 1, size) + (np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size))
    byte = np.where(at >= np.repeat(t.starts[long], size), data[np.maximum(at, 0)], BLANK).astype(np.int64)
    one, two = data[at + 1].astype(np.int64) & 31, data[at + 2].astype(np.int64) & 31
    three = np.where(at + 3 < np.repeat(t.ends[long], size), data[np.minimum(at + 3, len(data) - 1)], BLANK).astype(np.int64) & 31
    low = byte & 63
    return (one << 10 | two << 5 | three) * 64 + low, LOW_CELLS + ((one << 6 | low) << 2 | byte >> 6)


def spelling_model(events: np.ndarray) -> np.ndarray:
    """log10 probabilities of all cells; each context is mixed with the one that lacks its farthest byte."""
    counts = events[:LOW_CELLS].astype(float).reshape(32, 32, 32, 64)
    below = np.full(64, 1 / 64)
    for held in (counts.sum((0, 1, 2)), counts.sum((1, 2)), counts.sum(2), counts):
        below = below if held.ndim == 1 else below[..., None, :]
        below = (held + BACKOFF * below) / (held.sum(-1, keepdims=True) + BACKOFF)
    high = events[LOW_CELLS:].astype(float).reshape(-1, 4) + 0.01
    high /= high.sum(1, keepdims=True)
    return np.log10(np.concatenate([below.ravel(), high.ravel()])).astype(np.float32)


def word_counts(documents: DataFrame) -> DataFrame:
    """Rows (h, pair, n) over all given documents (doc_id, text); partial sums are made in the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            keys = np.concatenate([x[0] for x in held])
            distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
            return distinct, np.concatenate([x[1] for x in held])[first], np.bincount(back, weights=np.concatenate([x[2] for x in held])).astype(np.int64)

        def rows() -> pa.RecordBatch:
            keys, pairs, n = merged()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(pairs), pa.array(n)], ["h", "pair", "n"])

        ends = 0
        for batch in batches:
            ends += batch.num_rows
            for piece in pieces(batch.column("text")):
                t = tokens_of(piece)
                held.append((t.hashes, t.pairs, t.times))
                if len(held) >= 8:
                    held = [merged()]
                    if len(held[0][0]) > 1 << 20:
                        yield rows()
                        held = []
        if ends:
            held.append((np.array([END_HASH]), np.array([-1]), np.array([ends])))
            yield rows()

    parts = documents.select("text").mapInArrow(count, "h long, pair long, n long")
    return parts.groupBy("h").agg(F.first("pair").alias("pair"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    hot: np.ndarray  # hashes of the most frequent words, sorted
    hot_counts: np.ndarray
    hot_units: np.ndarray  # -1: not a unit of its own
    pair_group: np.ndarray  # 65536: group (from 0) of each pair
    pair_counts: np.ndarray  # 65536: training words of no unit of their own
    unit_counts: np.ndarray
    tokens: int
    distinct: int
    novel: float  # share of the spelling model

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (-1: not hot) and word units (-1: none)."""
        if not len(self.hot):
            return np.full(len(hashes), -1, np.int64), np.full(len(hashes), -1, np.int16)
        at = np.minimum(np.searchsorted(self.hot, hashes), len(self.hot) - 1)
        same = self.hot[at] == hashes
        return np.where(same, self.hot_counts[at], -1), np.where(same, self.hot_units[at], -1)

    def units(self, t: Tokens, words: np.ndarray) -> np.ndarray:
        """The unit of every word of a piece."""
        return np.where(words >= 0, words, self.pair_group[t.pairs] + 1).astype(np.int16)[t.distinct]


def _least_hot(counts: DataFrame) -> int:
    """The least count that at most ``MOST_HOT`` words reach, from a histogram of few classes."""
    rows = counts.where("pair >= 0").groupBy(F.floor(F.log2("n") * 16).alias("c")).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("words")).collect()
    total, least = 0, 1 << 62
    for r in sorted(rows, key=lambda r: -r["c"]):
        total += r["words"]
        if total > MOST_HOT:
            break
        least = r["least"]
    return least


def vocabulary(counts: DataFrame) -> Vocabulary:
    """What the tasks know of the counts: bounded by ``MOST_HOT`` and the number of pairs."""
    totals = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    top = counts.where((F.col("pair") >= 0) & (F.col("n") >= _least_hot(counts))).select("h", "n").toArrow()
    h, n = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.lexsort((h, -n))
    h, n = h[order], n[order]
    words = min(len(h), recurrent.UNITS - FIRST_WORD)
    own = counts.sparkSession.createDataFrame([(int(x),) for x in h[:words].view(np.int64)], "_h long")
    rest = counts.where("pair >= 0").join(F.broadcast(own), F.col("h") == F.col("_h"), "left_anti")
    by_pair = rest.groupBy("pair").agg(F.sum("n").alias("n"), F.sum((F.col("n") == 1).cast("long")).alias("once")).collect()
    pair_counts = np.zeros(1 << 16, np.int64)
    for r in by_pair:
        pair_counts[r["pair"]] = r["n"]
    pair_group = np.zeros(1 << 16, np.int64)
    frequent = np.argsort(-pair_counts, kind="stable")[:PAIR_GROUPS]
    pair_group[frequent[pair_counts[frequent] > 0]] = np.arange(1, 1 + int((pair_counts[frequent] > 0).sum()))
    units = np.zeros(recurrent.UNITS, np.int64)
    units[1:FIRST_WORD] = np.bincount(pair_group, weights=pair_counts, minlength=PAIR_GROUPS + 1) + 1
    units[FIRST_WORD : FIRST_WORD + words] = n[:words]
    ends = counts.where("pair < 0").first()
    units[recurrent.END] = ends["n"] if ends else 1
    unit = np.full(len(h), -1, np.int16)
    unit[:words] = FIRST_WORD + np.arange(words)
    order = np.argsort(h)
    unseen, outside = sum(r["once"] for r in by_pair), int(pair_counts.sum())
    novel = min(0.9, max(0.01, (unseen + 1) / (outside + 2)))
    return Vocabulary(h[order], n[order], unit[order], pair_group, pair_counts, units, totals[0] or 0, totals[1], novel)


def _batches(batches: Iterator[pa.RecordBatch], known: Vocabulary, note) -> Iterator[list[np.ndarray]]:
    """Documents as units, ``BATCH_UNITS`` at a time; ``note`` sees each piece's words."""
    held, size = [], 0
    for batch in batches:
        for piece in pieces(batch.column("text")):
            t = tokens_of(piece)
            counts, words = known.look(t.hashes)
            units = known.units(t, words)
            edge = np.searchsorted(t.rows, np.arange(len(piece) + 1))
            note(batch, piece, t, counts, words, edge)
            held += [units[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
            size += len(units) + len(piece)
            if size >= BATCH_UNITS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _encoded(documents: DataFrame, known: Vocabulary, part: Column) -> DataFrame:
    """A stored table of all documents as units (key, units), and of spelling counts (cell, n)."""
    shared = documents.sparkSession.sparkContext.broadcast(known)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        events = np.zeros(SPELLINGS, np.int64)
        for batch in batches:
            for piece in pieces(batch.column("text")):
                t = tokens_of(piece)
                _, words = known.look(t.hashes)
                outside = np.flatnonzero(words < 0)
                cells = spelling_events(t, outside)
                n = np.maximum(t.ends[t.example[outside]] - t.starts[t.example[outside]] - 1, 0)
                np.add.at(events, np.concatenate(cells), np.tile(np.repeat(t.times[outside], n), 2))
                units = np.ascontiguousarray(known.units(t, words), UNIT_KIND)
                edge = (np.searchsorted(t.rows, np.arange(len(piece) + 1)) * units.itemsize).astype(np.int32)
                found = pa.Array.from_buffers(pa.binary(), len(piece), [None, pa.py_buffer(edge), pa.py_buffer(units)])
                keys = batch.column("key").slice(piece.first, len(piece))
                yield pa.RecordBatch.from_arrays([keys, found, pa.nulls(len(piece), pa.int32()), pa.nulls(len(piece), pa.int64())], ENCODED)
        seen = np.flatnonzero(events)
        if len(seen):
            none = [pa.nulls(len(seen), pa.int64()), pa.nulls(len(seen), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(seen, pa.int32()), pa.array(events[seen])], ENCODED)

    path = scratch_path(documents.sparkSession, "units")
    keyed = documents.select(F.xxhash64(part, "text").alias("key"), "text")
    keyed.mapInArrow(encode, "key long, units binary, cell int, n long").write.parquet(path)
    return documents.sparkSession.read.parquet(path)


def _dealt(encoded: DataFrame, most: int) -> DataFrame:
    """Rows (piece, key, again, units): every document's piece of ``most`` follows from what it holds alone. Rows that
    are alike in id and text are numbered, so that however many they are they spread over the pieces."""
    texts = encoded.where("units is not null").select("key", "units")
    path = scratch_path(encoded.sparkSession, "repeats")
    texts.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").write.parquet(path)
    repeats = encoded.sparkSession.read.parquet(path)
    dealt = texts.withColumn("again", F.lit(0).cast("long"))
    if not repeats.isEmpty():
        single = dealt.join(repeats, "key", "left_anti")
        alike = texts.join(repeats, "key", "left_semi").groupBy("key").agg(F.first("units").alias("units")).join(repeats, "key")
        dealt = single.unionByName(alike.select("key", "units", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("again")))
    return dealt.withColumn("piece", F.pmod(F.xxhash64("key", "again"), F.lit(most)).cast("int"))


def _learned(start, rate: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the weights, as whole multiples of 1 / ``STEPS_OF_ONE``, times the units that each piece of a task met."""
    total = np.zeros(recurrent.SIZE + 1, np.int64)

    def learn(held: list[np.ndarray]) -> None:
        trainer = recurrent.Trainer(start.value, rate)
        trainer.learn(held)
        total[:-1] += np.rint(trainer.flat.astype(float) * STEPS_OF_ONE).astype(np.int64) * trainer.tokens
        total[-1] += trainer.tokens

    held: list[np.ndarray] = []
    now = None
    for batch in batches:
        for piece, units in zip(batch.column("piece").to_pylist(), batch.column("units"), strict=True):
            if piece != now and held:
                learn(held)
                held = []
            now = piece
            held.append(np.frombuffer(units.as_buffer(), UNIT_KIND))
    if held:
        learn(held)
    if total[-1]:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "x"])


def train(documents: DataFrame, known: Vocabulary, part: Column, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Averaged weights, and spelling counts, from all given documents.

    ``part`` (with the text) deals the documents over pieces of about ``PIECE_UNITS`` units, and the pieces over the rounds.
    Each piece is learned for itself, in the order of its keys, from the weights of the round before, and the average is
    taken of whole numbers: the weights do not depend on how the table is partitioned.
    """
    context = documents.sparkSession.sparkContext
    encoded = _encoded(documents, known, part)
    spelling = np.zeros(SPELLINGS, np.int64)
    cells = encoded.where("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    spelling[cells["cell"].to_numpy()] = cells["n"].to_numpy()

    each = max(1, round(known.tokens / rounds / PIECE_UNITS))
    tasks = min(each, MOST_TASKS)
    dealt = _dealt(encoded, each * rounds)
    flat = recurrent.initial(known.unit_counts)
    for turn in range(rounds):
        start = context.broadcast(flat)
        task = F.pmod(F.floor(F.col("piece") / rounds), F.lit(tasks)).cast("int")
        own = dealt.where(F.col("piece") % rounds == turn).withColumn("task", task).repartitionById(tasks, "task")
        in_order = own.sortWithinPartitions("piece", "key", "again").select("piece", "units")
        sums = in_order.mapInArrow(partial(_learned, start, RATE / (1 + turn)), "i long, x long").groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
        found = {r["i"]: int(r["x"]) for r in sums.toLocalIterator()}
        units = found.get(recurrent.SIZE, 0)
        if units:
            flat = np.array([found[i] / units / STEPS_OF_ONE for i in range(recurrent.SIZE)], np.float32)
    return flat, spelling


@dataclass
class Model:
    known: Vocabulary
    flat: np.ndarray
    spelling: np.ndarray  # log10 probabilities (float32) of the spelling cells

    def word_scores(self, t: Tokens, which: np.ndarray) -> np.ndarray:
        """Spelling probability (log10) of each chosen word within its group."""
        known = self.known
        n = t.ends[t.example[which]] - t.starts[t.example[which]] - 1
        low, high = spelling_events(t, which)
        total = np.concatenate([[0.0], np.cumsum(self.spelling[low] + self.spelling[high], dtype=float)])
        edge = np.concatenate([[0], np.cumsum(n)])
        rare = known.pair_group == 0
        within = np.where(rare, np.log10((known.pair_counts + 0.5) / (known.pair_counts[rare].sum() + 0.5 * rare.sum())), 0.0)
        return total[edge[1:]] - total[edge[:-1]] + within[t.pairs[which]]

    def mixed(self, spelled: np.ndarray, counts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """log10 probability of words within their groups, by spelling and corpus count."""
        size = np.bincount(self.known.pair_group, weights=self.known.pair_counts, minlength=PAIR_GROUPS + 1)[groups]
        novel = np.where(size > 0, self.known.novel, 1.0)
        with np.errstate(divide="ignore"):
            counted = np.log(np.where(size > 0, (1 - novel) * counts / np.maximum(size, 1), 0.0))
        return np.logaddexp(np.log(novel) + spelled * np.log(10), counted) / np.log(10)


def fit(documents: DataFrame, counts: DataFrame, part: Column) -> Model:
    """The model of stored ``word_counts`` and the documents (doc_id, text) they come from."""
    known = vocabulary(counts)
    flat, events = train(documents, known, part)
    return Model(known, flat, spelling_model(events))


_RARE = "array<struct<h:long,spelled:double,grp:int,n:long>>"


def _scored(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: the parts of its scores that a task knows, and its rare words."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("h", pa.int64()), ("spelled", pa.float64()), ("grp", pa.int32()), ("n", pa.int64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known, weights = model.known, recurrent.unpack(model.flat)
        ids: list[pa.Array] = []
        parts: list[tuple] = []
        rare: list[pa.Array] = []

        def note(batch, piece, t, counts, words, edge) -> None:
            n = len(piece)
            groups = known.pair_group[t.pairs] if len(t.pairs) else np.empty(0, np.int64)
            hot, outside = counts >= 0, np.flatnonzero(words < 0)
            spelled = np.zeros(len(t.hashes))
            spelled[outside] = model.word_scores(t, outside)
            middle = np.flatnonzero(hot & (words < 0))
            within = np.zeros(len(t.hashes))
            within[middle] = model.mixed(spelled[middle], counts[middle], groups[middle])
            plain = np.where(hot, np.log10(np.maximum(counts, 0) + 1.0), 0.0)
            base = np.bincount(t.rows, weights=plain[t.distinct], minlength=n)
            inside = np.bincount(t.rows, weights=within[t.distinct], minlength=n)
            is_hot = hot[t.distinct]
            cold = np.flatnonzero(~is_hot)
            key, times = np.unique(t.rows[cold] * len(t.hashes) + t.distinct[cold], return_counts=True)
            row, lead = np.divmod(key, max(1, len(t.hashes)))
            fields = [t.hashes[lead].view(np.int64), spelled[lead], groups[lead].astype(np.int32), times]
            values = pa.StructArray.from_arrays([pa.array(x) for x in fields], ["h", "spelled", "grp", "n"])
            to = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
            rare.append(pa.ListArray.from_arrays(pa.array(to), values).cast(kind))
            ids.append(batch.column("doc_id").slice(piece.first, n))
            parts.append((np.diff(edge) + 1, np.bincount(t.rows[is_hot], minlength=n), base, inside))

        for held in _batches(batches, known, note):
            found = recurrent.score(weights, held) / np.log(10)
            n_tokens, n_hot, base, inside = (np.concatenate(x) for x in zip(*parts, strict=True))
            columns = [pa.array(n_tokens), pa.array(n_hot.astype(np.int64)), pa.array(base.astype(float)), pa.array(found + inside)]
            table = pa.Table.from_arrays([pa.chunked_array(ids), *(pa.chunked_array([c]) for c in columns), pa.chunked_array(rare)], ["doc_id", "n_tokens", "n_hot", "base", "inside", "rare"])
            yield from table.combine_chunks().to_batches(max_chunksize=2000)
            ids.clear(), parts.clear(), rare.clear()

    doc_kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(score, f"doc_id {doc_kind}, n_tokens long, n_hot long, base double, inside double, rare {_RARE}")


def score(documents: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark, known = documents.sparkSession, model.known
    path = scratch_path(spark, "scored")
    _scored(documents, model).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    parts = spark.read.parquet(path)
    rare = parts.select("_row", F.explode("rare").alias("w")).select("_row", "w.*")
    met = rare.join(counts.select(F.col("h").alias("_h"), F.col("n").alias("c")), F.col("h") == F.col("_h"), "left")
    count, times = F.coalesce("c", F.lit(0)), F.col("n")
    size = np.bincount(known.pair_group, weights=known.pair_counts, minlength=PAIR_GROUPS + 1)
    group_size = F.element_at(F.array(*(F.lit(float(x)) for x in size)), F.col("grp") + 1)
    novel = F.when(group_size > 0, F.lit(known.novel)).otherwise(F.lit(1.0))
    # In logarithms: the probability of a long word's spelling is below the smallest double.
    spelled = F.log10(novel) + F.col("spelled")
    counted = F.log10((1 - novel) * count / group_size)
    both = F.greatest(spelled, counted) + F.log10(1 + F.pow(F.lit(10.0), -F.abs(spelled - counted)))
    word = F.when((count > 0) & (group_size > 0), both).otherwise(spelled)
    sums = met.groupBy("_row").agg(
        F.sum(times * F.log10(count + F.lit(1.0))).alias("rare_base"),
        F.sum(times * word).alias("rare_inside"),
        F.sum(F.when(count > 0, times).otherwise(0)).alias("rare_known"),
    )
    ends = int(known.unit_counts[recurrent.END]) if known.tokens else 0
    total = float(np.log10(known.tokens + known.distinct + 1))
    zero = F.lit(0.0)
    return parts.drop("rare").join(sums, "_row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_hot") + F.coalesce("rare_known", F.lit(0)) + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero) + F.lit(float(np.log10(ends + 1))) - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("inside") + F.coalesce("rare_inside", zero)).alias("score"),
    )


def fit_and_score(documents: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents by a model of those where ``training`` holds."""
    spark = documents.sparkSession
    text = F.col(text_col).cast("string")
    taught = documents.where(training).select(F.col(id_col).alias("doc_id"), text.alias("text"))
    path = scratch_path(spark, "words")
    word_counts(taught).write.parquet(path)
    counts = spark.read.parquet(path)
    model = fit(taught, counts, F.xxhash64("doc_id", F.lit(5)))
    return score(documents.select(F.col(id_col).alias("doc_id"), text.alias("text")), counts, model)
