"""Host-level quality rules: rule failures per host, shrunk by an empirical beta prior, decide for its documents.

Words are runs of characters other than space and 0x09-0x0D. A document fails

* ``base``: under 10 words, or over a fifth of its words lie in 5-word windows that recur in it;
* ``symbols``: over a tenth as many symbols ``#*$%&|<>`` as characters in words;
* ``lines``: over half of its lines with a word repeat an earlier line.

Of each rule the failure rate of a host is shrunk towards the rate of all hosts: a beta prior with
the mean and variance of the hosts' rates (method of moments, at least ``least_prior`` and at most
``most_prior`` documents strong) meets the host's counts. The posterior decides two things. A host whose shrunk rate
exceeds ``most_rate`` for any rule is condemned and none of its documents is kept. A host whose rate lies above that
of all hosts by ``doubt`` standard deviations of its posterior is doubted for that rule: its documents must then meet
the rule's strict form (symbols: a fifteenth of the characters in words; lines: a third; base: 15 percent of its words, the
least length staying). A document is kept if its host is not condemned and it fails no rule that holds for it.

Defined results: a null or empty text has no words and fails ``base``; a null host is a host of
its own; repeated rows count each time; an empty table gives an empty result; other columns of the
documents are never read, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.components import looked_up
from cohortloom.llm.textbytes import NOT_SPACE, Piece, byte_table, covered, pieces, run_hashes
from cohortloom.session import cut_lineage, scratch_path

SYMBOLS = byte_table(*((ord(c), ord(c)) for c in "#*$%&|<>"))
NOT_NEWLINE = ~byte_table((0x0A, 0x0A))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = ("base", "symbols", "lines")
WINDOW_WORDS = 5


def _keyed(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return (hashes ^ (rows.astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15) + rows.astype(np.uint64)


def measure(piece: Piece) -> list[np.ndarray]:
    """The ``MEASURES`` of each row."""
    n = len(piece)
    starts, ends, rows = piece.spans(NOT_SPACE)
    words = piece.hashes(starts, ends)
    in_word = NOT_SPACE[piece.data]
    chars = piece.per_row(in_word & ((piece.data & 0xC0) != 0x80))

    first, last, of = piece.spans(NOT_NEWLINE)
    filled = np.concatenate([[0], np.cumsum(in_word)])
    full = filled[last] > filled[first]
    first, last, of = first[full], last[full], of[full]
    lines = np.bincount(of, minlength=n)
    key = _keyed(piece.hashes(first, last), of)
    _, at = np.unique(key, return_index=True)
    distinct = np.bincount(of[at], minlength=n)

    at, runs = run_hashes(words, rows, WINDOW_WORDS)
    order = np.argsort(key := _keyed(runs, rows[at]), kind="stable")
    same = np.zeros(len(key), bool)
    if len(key) > 1:
        equal = key[order[1:]] == key[order[:-1]]
        same[order[1:]] |= equal
        same[order[:-1]] |= equal
    repeated = covered(at[same], WINDOW_WORDS, len(words))
    return [np.bincount(rows, minlength=n), chars, piece.per_row(SYMBOLS[piece.data]), lines, lines - distinct, np.bincount(rows[repeated], minlength=n)]


def measures(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str | Column = "source") -> DataFrame:
    """One row per document: doc_id, host and the ``MEASURES``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                own = batch.slice(piece.first, len(piece))
                found = [pa.array(x.astype(np.int64)) for x in measure(piece)]
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("host"), *found], ["doc_id", "host", *MEASURES])

    host = F.col(host) if isinstance(host, str) else host
    rows = documents.select(F.col(id_col).alias("doc_id"), host.cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, host string, " + ", ".join(f"{m} long" for m in MEASURES))


def with_rules(measured: DataFrame) -> DataFrame:
    """Adds flags ``fails_<rule>`` and ``strict_<rule>`` for each rule."""
    return measured.withColumns(
        {
            "fails_base": F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"),
            "fails_symbols": F.expr("10 * n_symbols > word_chars"),
            "fails_lines": F.expr("2 * n_dup_lines > n_lines"),
            "strict_base": F.expr("n_words < 10 or 100 * n_repeat_words > 15 * n_words"),
            "strict_symbols": F.expr("15 * n_symbols > word_chars"),
            "strict_lines": F.expr("3 * n_dup_lines > n_lines"),
        }
    )


def host_verdicts(judged: DataFrame, most_rate: float = 0.5, doubt: float = 1.0, least_prior: float = 2.0, most_prior: float = 1000.0) -> DataFrame:
    """One row per host: host, n_docs, ``rate_<rule>`` (shrunk), ``doubts_<rule>`` and condemned. Counts are summed before the shuffle."""
    counts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *(F.sum(F.col(f"fails_{r}").cast("long")).alias(f"k_{r}") for r in RULES))
    counts = cut_lineage(counts)
    rates = [F.col(f"k_{r}") / F.col("n_docs") for r in RULES]
    moments = counts.agg(*(F.avg(x) for x in rates), *(F.var_pop(x) for x in rates)).first()
    shrunk, doubts = {}, {}
    for i, r in enumerate(RULES):
        mean, var = moments[i] or 0.0, moments[i + len(RULES)] or 0.0
        strength = min(most_prior, max(least_prior, mean * (1 - mean) / var - 1)) if var > 0 else most_prior
        rate = (F.col(f"k_{r}") + F.lit(strength * mean)) / (F.col("n_docs") + F.lit(strength))
        spread = F.sqrt(rate * (1 - rate) / (F.col("n_docs") + F.lit(strength + 1)))
        shrunk[f"rate_{r}"] = rate
        doubts[f"doubts_{r}"] = rate - F.lit(mean) > F.lit(doubt) * spread
    worst = F.greatest(*shrunk.values())
    return counts.select("host", "n_docs", *(x.alias(c) for c, x in (shrunk | doubts).items()), (worst > most_rate).alias("condemned"))


def judge(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str | Column = "source", **limits: float) -> DataFrame:
    """One row per document: doc_id, host, measures, failed rules, verdicts of its host and ``kept``.

    The texts are read once; their measures, a few numbers a row, are kept in a written table.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "host-rules")
    with_rules(measures(documents, id_col, text_col, host)).write.parquet(path)
    judged = spark.read.parquet(path)
    flags = ["condemned", *(f"doubts_{r}" for r in RULES)]
    found = host_verdicts(judged, **limits).where(" or ".join(flags))
    verdicts = found.select(F.struct(F.col("host").isNotNull(), F.coalesce("host", F.lit(""))).alias("_host"), *flags)
    verdicts = cut_lineage(verdicts)
    keyed = judged.withColumn("_host", F.struct(F.col("host").isNotNull(), F.coalesce("host", F.lit(""))))
    # Hosts in doubt are one row each: broadcast, or with many of them joined with the hot hosts split.
    joined = looked_up(keyed, verdicts, "_host").drop("_host").na.fill(False, flags)
    fails = " or ".join(f"fails_{r} or doubts_{r} and strict_{r}" for r in RULES)
    return joined.withColumn("kept", F.expr(f"not condemned and not ({fails})"))


def digest(judged: DataFrame) -> DataFrame:
    """The report columns of ``judge``."""
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.col("fails_base").alias("base_failed"), "kept")
