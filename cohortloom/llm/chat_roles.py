"""Transcript parsing: a hidden Markov model recovers who speaks in each line, and canonical turns are rendered.

The states are a role's first line and its further lines; the roles are those of the transcripts it learns from. A
line shows features: its speaker marker (a name before a colon or ``>``, whatever follows, or a dash alone), its
length, its last character, and whether it begins with a capital. Transitions and the features' frequencies are
counted from transcripts with known roles. A marker that these do not have counts as any other unknown one.

Viterbi runs in chunks of ``CHUNK`` lines, so that one very long transcript, or one very long turn, is spread over tasks:
each chunk first gives, for every state before it and every state at its end, the score of the best
path between; these small matrices settle the states at all chunk borders of a transcript, and each
chunk is then decoded between its borders. The result is the same as in one piece.

Defined results: lines are in the order of position, line and text; a repeated row is one line; a row
without a transcript id is a transcript of its own; a null text is an empty line; an empty table gives
an empty result; a turn that goes on into the next chunk is rendered in parts, of which the later
ones say so (``continues``); of equally good paths the one of the first role in alphabetical order is taken; a null
role teaches nothing, and without any known role every line is of the role ``unknown``; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.components import looked_up
from cohortloom.llm.sorted_groups import whole_groups
from cohortloom.operators.ranking import global_index
from cohortloom.session import cut_lineage, scratch_path

CHUNK = 4096
SMOOTHING = 0.5
#: Not before a slash, as in an address.
MARKER = r"^\s*(?:([A-Za-z][A-Za-z ]{0,19}?)\s*[:>](?!/)|(-)(?=\s|$))\s?"
_MARKER = re.compile(MARKER)
LENGTHS = 12


def marker(line: Column) -> Column:
    """The lower-cased speaker marker of a line, or an empty text."""
    return F.lower(F.concat(F.regexp_extract(line, MARKER, 1), F.regexp_extract(line, MARKER, 2)))


def _shape(line: Column) -> Column:
    """Length class, last character class and leading capital as one number."""
    bare = F.regexp_replace(line, MARKER, "")
    size = F.least(F.lit(LENGTHS - 1), F.floor(F.log2(F.length(bare) + F.lit(1.0)))).cast("int")
    last = F.right(F.rtrim(bare), F.lit(1))
    end = F.when(last == "?", 1).when(last.isin(".", "!"), 2).when(last == "", 3).otherwise(0)
    return size * 8 + end * 2 + bare.rlike(r"^\s*[A-Z]").cast("int")


def lines_of(rows: DataFrame, conv_col: str, position_col: str, text_col: str, role_col: str | None = None) -> DataFrame:
    """One row per line: conv, position, line, text, marker, shape, and the true role, lower-cased, if roles are known."""
    conv = F.coalesce(F.col(conv_col).cast("string"), F.concat(F.lit("null "), F.xxhash64(position_col, text_col).cast("string")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = [] if role_col is None else [F.lower(F.col(role_col).cast("string")).alias("role")]
    given = rows.select(conv.alias("conv"), F.col(position_col).cast("long").alias("position"), text.alias("turn_text"), *known).distinct()
    out = given.select("*", F.posexplode(F.split("turn_text", "\n")).alias("line", "text")).drop("turn_text")
    return out.withColumns({"marker": marker(F.col("text")), "shape": _shape(F.col("text"))})


@dataclass
class Model:
    #: State 2 * role is the role's first line, 2 * role + 1 a further one.
    roles: list[str]
    start: np.ndarray  # log-probabilities of the first line's state
    step: np.ndarray  # from state, to state
    shapes: np.ndarray  # state, shape
    markers: dict[str, np.ndarray]  # by state; "" for none
    other: np.ndarray

    def emissions(self, markers: list[str], shapes: np.ndarray) -> np.ndarray:
        known = np.array([self.markers.get(m, self.other) for m in markers]).reshape(-1, 2 * len(self.roles))
        return known + self.shapes[:, shapes].T


def _log(counts: np.ndarray) -> np.ndarray:
    counts = counts + SMOOTHING
    return np.log(counts / counts.sum(-1, keepdims=True))


def learn(lines: DataFrame) -> Model:
    """Counts over lines with known roles (``lines_of`` with roles).

    What reaches the driver are counts by role, shape and marker. Of the markers these are the ones that two
    lines at least begin with: a name that only one line has tells nothing about others.
    """
    path = scratch_path(lines.sparkSession, "states")
    lines.where("role is not null").select("conv", "position", "line", "role", "marker", "shape").write.parquet(path)
    known = lines.sparkSession.read.parquet(path)
    roles = sorted(r["role"] for r in known.select("role").distinct().collect()) or ["unknown"]
    number = lines.sparkSession.createDataFrame(list(enumerate(roles)), "_number int, role string")
    state = 2 * F.col("_number") + (F.col("line") > 0).cast("int")
    known = known.join(F.broadcast(number), "role").withColumn("state", state).drop("role", "_number")
    n_states = 2 * len(roles)
    # Within a turn the next line is known; a turn's last line is followed by the next position's first state.
    shapes, inner = np.zeros((n_states, LENGTHS * 8)), np.zeros((n_states, n_states))
    for r in known.groupBy("state", "shape").agg(F.count(F.lit(1)).alias("n")).collect():
        shapes[r["state"], r["shape"]] = r["n"]
    turns = known.groupBy("conv", "position").agg((F.floor(F.min("state") / 2)).cast("int").alias("role"), F.count(F.lit(1)).alias("lines"))
    for r in turns.groupBy("role").agg(F.sum(F.when(F.col("lines") > 1, 1).otherwise(0)).alias("more"), F.sum(F.greatest(F.col("lines") - 2, F.lit(0))).alias("further")).collect():
        inner[2 * r["role"], 2 * r["role"] + 1] += r["more"]
        inner[2 * r["role"] + 1, 2 * r["role"] + 1] += r["further"]
    now, after = turns.alias("a"), turns.select("conv", (F.col("position") - 1).alias("position"), F.col("role").alias("next")).alias("b")
    for r in now.join(after, ["conv", "position"]).groupBy("role", (F.col("lines") > 1).alias("long"), "next").agg(F.count(F.lit(1)).alias("n")).collect():
        inner[2 * r["role"] + int(r["long"]), 2 * r["next"]] += r["n"]
    first = np.zeros(n_states)
    least = turns.groupBy("conv").agg(F.min_by("role", F.coalesce("position", F.lit(-(1 << 62)))).alias("role"))
    for r in least.groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect():
        first[2 * r["role"]] = r["n"]
    marked = known.groupBy("marker", "state").agg(F.count(F.lit(1)).alias("n"))
    often = marked.groupBy("marker").agg(F.sum("n").alias("total"), F.collect_list(F.struct("state", "n")).alias("by"))
    frequent = often.where("total > 1").select("marker", "by").collect()
    names = sorted(r["marker"] for r in frequent)
    named, place = np.zeros((n_states, len(names) + 1)), {m: i for i, m in enumerate(names)}
    for r in frequent:
        for s, n in r["by"]:
            named[s, place[r["marker"]]] = n
    for r in often.where("total = 1").select(F.explode("by").alias("b")).groupBy("b.state").agg(F.sum("b.n").alias("n")).collect():
        named[r["state"], -1] = r["n"]
    marks = _log(named)
    step = _log(inner)
    for r in range(len(roles)):  # a further line follows a line of its own role
        for s in range(n_states):
            if s // 2 != r:
                step[s, 2 * r + 1] = -math.inf
    start = np.where(np.arange(n_states) % 2 == 0, _log(first), -math.inf)
    return Model(roles, start, step, _log(shapes), {n: marks[:, i] for i, n in enumerate(names)}, marks[:, -1])


def _best_paths(model: Model, emissions: np.ndarray, opening: bool) -> np.ndarray:
    """Best score from each state before the lines (all rows alike if none is before) to each at their end."""
    total = model.start[None, :] + emissions[0] if opening else model.step + emissions[0]
    total = np.broadcast_to(total, model.step.shape).copy()
    for own in emissions[1:]:
        total = (total[:, :, None] + model.step[None]).max(1) + own
    return total


def decode(model: Model, emissions: np.ndarray, before: int, end: int) -> np.ndarray:
    """The best states of the lines between a state before them (-1: none) and their last state (-1: any)."""
    score = (model.start if before < 0 else model.step[before]) + emissions[0]
    back = np.zeros(emissions.shape, np.int8)
    for i in range(1, len(emissions)):
        ways = score[:, None] + model.step
        back[i] = ways.argmax(0)
        score = ways.max(0) + emissions[i]
    out = np.empty(len(emissions), np.int64)
    out[-1] = int(score.argmax()) if end < 0 else end
    for i in range(len(emissions) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def borders(model: Model, matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, state at the end) of each chunk of a transcript, of the best path through all."""
    score, scores = matrices[0][0], [matrices[0][0]]
    for m in matrices[1:]:
        score = (score[:, None] + m).max(0)
        scores.append(score)
    ends = [int(scores[-1].argmax())]
    for k in range(len(matrices) - 1, 0, -1):
        ends.append(int((scores[k - 1] + matrices[k][:, ends[-1]]).argmax()))
    ends.reverse()
    return [(ends[k - 1] if k else -1, ends[k]) for k in range(len(matrices))]


_ORDER = ["position", "line", "text"]


def _chunked(lines: DataFrame) -> DataFrame:
    """Lines with their chunk: 0 in transcripts of up to ``CHUNK`` lines; those of longer ones are numbered in
    order, whatever positions they have, and cut at every ``CHUNK``."""
    path = scratch_path(lines.sparkSession, "lines")
    lines.write.parquet(path)
    stored = lines.sparkSession.read.parquet(path)
    sizes = stored.groupBy("conv").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CHUNK).select("conv", F.lit(True).alias("_long"))
    marked = looked_up(stored, cut_lineage(sizes), "conv")
    short = marked.where("_long is null").drop("_long").withColumn("chunk", F.lit(0).cast("long"))
    ranked = global_index(marked.where("_long").drop("_long"), ["conv", *_ORDER], "_place", start=0)
    return short.unionByName(ranked.withColumn("chunk", F.expr(f"_place div {CHUNK}")).drop("_place"))


def recover(lines: DataFrame, model: Model, rows_at_once: int = 50_000) -> DataFrame:
    """Rendered turns: conv, position, line (of the first line), role, n_lines, continues, rendered."""
    spark = lines.sparkSession
    shared = spark.sparkContext.broadcast(model)
    chunked = _chunked(lines)
    least = chunked.groupBy("conv").agg(F.min("chunk").alias("first_chunk"), F.max("chunk").alias("last_chunk"))
    long = least.where("first_chunk < last_chunk")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["conv", "chunk"], rows_at_once):
            shown = shared.value.emissions(table["marker"].to_pylist(), np.array(table["shape"]))
            opening = np.array(table["chunk"]) == np.array(table["first_chunk"])
            found = [_best_paths(shared.value, shown[a:b], bool(opening[a])) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            at = pa.array(starts[:-1])
            yield pa.RecordBatch.from_arrays([table["conv"].combine_chunks().take(at), table["chunk"].combine_chunks().take(at), pa.array([m.ravel().tolist() for m in found], pa.list_(pa.float64()))], ["conv", "chunk", "m"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["conv"], rows_at_once):
            m = table["m"].to_pylist()
            ends = [e for a, b in zip(starts[:-1], starts[1:], strict=True) for e in borders(shared.value, [np.array(x).reshape(shared.value.step.shape) for x in m[a:b]])]
            yield pa.RecordBatch.from_arrays([*(table[c].combine_chunks() for c in ("conv", "chunk")), pa.array([e[0] for e in ends], pa.int32()), pa.array([e[1] for e in ends], pa.int32())], ["conv", "chunk", "before", "end"])

    # Only transcripts of more than one chunk have borders to settle.
    pieces = chunked.join(long, "conv").select("conv", "chunk", "position", "line", "text", "marker", "shape", "first_chunk")
    found = pieces.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", *_ORDER).mapInArrow(matrices, "conv string, chunk long, m array<double>")
    settled = found.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(settle, "conv string, chunk long, before int, end int")
    path = scratch_path(spark, "borders")
    settled.write.parquet(path)
    joined = chunked.join(spark.read.parquet(path), ["conv", "chunk"], "left")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for table, starts in whole_groups(batches, ["conv", "chunk"], rows_at_once):
            texts, marks = table["text"].to_pylist(), table["marker"].to_pylist()
            shown = model.emissions(marks, np.array(table["shape"]))
            before, end = (np.array(table[c].fill_null(-1)) for c in ("before", "end"))
            out = []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                states = decode(model, shown[a:b], int(before[a]), int(end[a]))
                new = np.flatnonzero(states % 2 == 0) + a
                new = new if len(new) and new[0] == a else np.append(a, new)
                for x, y in zip(new.tolist(), np.append(new[1:], b).tolist(), strict=True):
                    body = [texts[x] if states[x - a] % 2 else _MARKER.sub("", texts[x], count=1), *texts[x + 1 : y]]
                    role = model.roles[states[x - a] // 2]
                    out.append((x, role, y - x, bool(states[x - a] % 2), canonical(role, "\n".join(body))))
            at = pa.array([o[0] for o in out])
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.string()]
            arrays = [*(table[c].combine_chunks().take(at) for c in ("conv", "position", "line")), *(pa.array([o[i + 1] for o in out], k) for i, k in enumerate(kinds))]
            yield pa.RecordBatch.from_arrays(arrays, ["conv", "position", "line", "role", "n_lines", "continues", "rendered"])

    ordered = joined.select("conv", "chunk", "position", "line", "text", "marker", "shape", "before", "end").repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", *_ORDER)
    return ordered.mapInArrow(render, "conv string, position long, line int, role string, n_lines long, continues boolean, rendered string")


def canonical(role: str, text: str) -> str:
    return f"<|{role}|>\n{text.strip()}\n<|end|>"
