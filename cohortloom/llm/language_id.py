"""Language identification by bit-sliced Bloom filters over byte n-grams.

Texts are lower-cased in Latin letters and everything but letters becomes a space; an n-gram is ``SIZE`` bytes
with at least ``SIZE - 1`` bytes of letters. A language learns the n-grams that make up at least
``LEAST_SHARE`` of its own, so at most 1 / ``LEAST_SHARE`` of them, however large the corpus. All
languages share one array of bit masks: slot by slot, bit i belongs to the filter of language i, and
the AND of an n-gram's slots names all languages that contain it. A mask has 64 languages; more of them take
further arrays. A text's hits are counted per
language, corrected for the filter's known rate of false positives, and weighted by how few
languages an n-gram names; the language with the highest corrected rate wins and its share of the
sum is the score.

Defined results: a null text, or one without a letter, is ``und`` with score 0; a text without any
known n-gram takes the language with the most text, score 1 / languages; ties go to the
first language in alphabetical order; a null language teaches nothing; without anything to learn
from all texts are ``und``; repeated rows count each time; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortloom.llm.textbytes import LOWER, Piece, byte_table, mix, pieces
from cohortloom.session import scratch_path

SIZE = 4
LEAST_SHARE = 5e-6
PROBES = 3
#: Languages of one array of masks.
MASK_BITS = 64

LETTERS = byte_table((0x61, 0x7A), (0x80, 0xFF))
NORMAL = np.where(LETTERS[LOWER], LOWER, 0x20).astype(np.uint8)


def grams(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Positions and codes of the n-grams of a piece; none crosses a row."""
    data = NORMAL[piece.data]
    # The capitals from 0xC0 to 0xDE are two bytes, of which the second lies 0x20 below that of their small letter.
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    data[capital] += 0x20
    count = len(data) - SIZE + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    code = np.zeros(count, np.uint32)
    letters = np.zeros(count, np.uint8)
    for i in range(SIZE):
        own = data[i : i + count]
        code = (code << np.uint32(8)) | own
        letters += own != 0x20
    good = letters >= SIZE - 1
    for i in range(1, SIZE):  # not over the end of a row
        ends = piece.bounds[1:-1] - i
        good[ends[(ends >= 0) & (ends < count)]] = False
    at = np.flatnonzero(good)
    return at, code[at]


@dataclass
class Filters:
    languages: list[str]
    masks: list[np.ndarray]  # one array for each ``MASK_BITS`` languages
    false_rate: np.ndarray
    amounts: np.ndarray

    def lookup(self, codes: np.ndarray) -> list[np.ndarray]:
        """The masks of the languages that contain each n-gram."""
        found: list[np.ndarray] = []
        for slot in slots(codes, len(self.masks[0])):
            own = [m[slot] for m in self.masks]
            found = [a & b for a, b in zip(found, own, strict=True)] if found else own
        return found

    def holders(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        """For each language in turn, which n-grams it contains."""
        found = self.lookup(codes)
        for i in range(len(self.languages)):
            own = found[i // MASK_BITS]
            yield (own & own.dtype.type(1 << i % MASK_BITS)) != 0


def slots(codes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    key = mix(codes.astype(np.uint64) + np.uint64(1))
    step = (key >> np.uint64(40)) | np.uint64(1)
    for i in range(PROBES):
        yield ((key + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64)


def gram_counts(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (lang, gram, n) over all given documents; partial sums are made in the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return codes, np.bincount(back, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

        def rows(lang: str) -> pa.RecordBatch:
            codes, n = merged(kept.pop(lang))
            return pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(codes), np.int64))), pa.array(codes.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for piece in pieces(batch.column("text")):
                at, codes = grams(piece)
                row = np.searchsorted(piece.bounds, at, "right") - 1
                own = langs[piece.first : piece.first + len(piece)]
                for lang in dict.fromkeys(own):
                    codes_of, n = np.unique(codes[(own == lang)[row]], return_counts=True)
                    parts = kept.setdefault(lang, [])
                    parts.append((codes_of, n))
                    if len(parts) >= 16:
                        kept[lang] = [merged(parts)]
                        if len(kept[lang][0][0]) > 1 << 20:
                            yield rows(lang)
        for lang in list(kept):
            yield rows(lang)

    taught = documents.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    parts = taught.mapInArrow(count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters from all the given documents. The driver gets at most languages / LEAST_SHARE n-grams."""
    path = scratch_path(documents.sparkSession, "grams")
    gram_counts(documents, text_col, lang_col).write.parquet(path)
    counts = documents.sparkSession.read.parquet(path)
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    known = documents.sparkSession.createDataFrame([(lang, float(n)) for lang, n in totals.items()], "lang string, total double")
    frequent = counts.join(F.broadcast(known), "lang").withColumn("share", F.col("n") / F.col("total")).where(F.col("share") >= LEAST_SHARE)
    table = frequent.select("lang", "gram").toArrow()
    gram = table["gram"].to_numpy()
    of = np.array(table["lang"].to_pylist(), object)
    return build({lang: np.sort(gram[of == lang]).astype(np.uint32) for lang in languages}, totals)


def build(known: dict[str, np.ndarray], amounts: dict[str, int] | None = None) -> Filters:
    """The shared array of masks for each language's n-grams; ``amounts`` of text decide where nothing is known."""
    languages = sorted(known)
    largest = max([1, *(len(x) for x in known.values())])
    size = 1 << max(12, int(largest * 8).bit_length())
    kind = next(k for bits, k in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, np.uint64)) if min(len(languages), MASK_BITS) <= bits)
    masks = [np.zeros(size, kind) for _ in range(max(1, -(-len(languages) // MASK_BITS)))]
    rates = np.zeros(len(languages))
    for i, lang in enumerate(languages):
        own = np.zeros(size, bool)
        for slot in slots(known[lang], size):
            own[slot] = True
        rates[i] = own.mean() ** PROBES
        masks[i // MASK_BITS][own] |= kind(1 << i % MASK_BITS)
    return Filters(languages, masks, rates, np.array([(amounts or {}).get(x, 0) for x in languages]))


def _has_letter(piece: Piece) -> np.ndarray:
    sure = piece.per_row(byte_table((0x41, 0x5A), (0x61, 0x7A))[piece.data]) > 0
    for r in np.flatnonzero(~sure & (np.diff(piece.bounds) > 0)).tolist():
        sure[r] = any(c.isalpha() for c in piece.text(r).decode())
    return sure


def classify(piece: Piece, filters: Filters) -> tuple[list[str], np.ndarray]:
    """Language and score of each row."""
    n, many = len(piece), len(filters.languages)
    letters = _has_letter(piece)
    if not many:
        return ["und"] * n, np.zeros(n)
    at, codes = grams(piece)
    row = np.searchsorted(piece.bounds, at, "right") - 1
    total = np.bincount(row, minlength=n)
    named = np.zeros(len(codes), np.uint16)
    for held in filters.holders(codes):
        named += held
    hits = np.zeros((n, many))
    for i, held in enumerate(filters.holders(codes)):
        own = np.flatnonzero(held)
        hits[:, i] = np.bincount(row[own], weights=1.0 / named[own], minlength=n)
    # A false positive would add its weight at this rate to the n-grams outside the language.
    rate = filters.false_rate / (1 + (many - 1) * filters.false_rate.mean())
    rates = np.maximum(hits - rate * total[:, None], 0.0)
    sums = rates.sum(1)
    best = rates.argmax(1)
    known = sums > 0
    score = np.where(known, rates.max(1) / np.where(known, sums, 1), 1.0 / many)
    best = np.where(known, best, int(filters.amounts.argmax()))
    names = np.array([*filters.languages, "und"], object)
    return names[np.where(letters, best, many)].tolist(), np.where(letters, score, 0.0)


def predict(documents: DataFrame, filters: Filters, text_col: str = "text", keep: list[str] | None = None, into: str = "language") -> DataFrame:
    """The columns ``keep`` (all) plus a struct of lang and score, for each document."""
    columns = [c for c in (documents.columns if keep is None else keep) if c != into]
    rows = documents.select(*columns, F.col(text_col).cast("string").alias("_text"))
    shared = documents.sparkSession.sparkContext.broadcast(filters)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.num_columns - 1
            for piece in pieces(batch.column(width)):
                own = batch.slice(piece.first, len(piece))
                langs, scores = classify(piece, shared.value)
                found = pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])
                yield pa.RecordBatch.from_arrays([*own.columns[:width], found], [*own.schema.names[:width], into])

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(into, T._parse_datatype_string("struct<lang:string,score:double>"))])
    return rows.mapInArrow(score, schema)
