"""Token counts per field or section: each document is encoded once, whole.

The tokens' character spans are joined with the sections' spans. A token within one section counts
there; a token that crosses a boundary is allocated by a rule:

* ``first``: to the section of its first byte;
* ``most``: to the section that holds most of its bytes, the earlier one of equals;
* ``split``: to each section in proportion to its bytes (``n_tokens`` is then a fraction).

So the counts of a document's sections add up to the tokens of the whole document.

Defined results: a null or empty text is one empty section without tokens; a repeated row is counted
each time; an empty table gives an empty result; columns besides those named are never read, so
names cannot clash. In ``field_counts`` a null field is an empty section.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.textbytes import Piece, pieces
from cohortloom.llm.tokens import DEFAULT_FILE, encoder

RULES = ("first", "most", "split")


def allocate(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of those that reach into it cross its boundary.

    Both inputs are ascending byte positions that end at the same place; sections may be empty.
    """
    n = len(section_ends)
    if not len(token_ends):
        return np.zeros(n), np.zeros(n, np.int64)
    starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends - 1, "right")
    crosses = np.flatnonzero(first != last)
    inside = first == last
    counts = np.bincount(first[inside], minlength=n).astype(float)
    crossing = np.zeros(n, np.int64)
    section_starts = np.concatenate([[0], section_ends[:-1]])
    for t in crosses.tolist():
        a, b = int(first[t]), int(last[t]) + 1
        held = np.minimum(section_ends[a:b], token_ends[t]) - np.maximum(section_starts[a:b], starts[t])
        crossing[a:b] += held > 0
        if rule == "first":
            counts[a] += 1
        elif rule == "most":
            counts[a + int(np.argmax(held))] += 1
        else:
            counts[a:b] += held / held.sum()
    return counts, crossing


def _line_ends(raw: np.ndarray) -> np.ndarray:
    """A section is a line with the newline that ends it."""
    ends = np.flatnonzero(raw == 0x0A) + 1
    return ends if len(ends) and ends[-1] == len(raw) else np.append(ends, len(raw))


def _counted(rows: DataFrame, rule: str, tokenizer: str) -> DataFrame:
    if rule not in RULES:
        raise ValueError(rule)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            ids, given = batch.column("doc_id"), batch.column("ends").to_pylist()
            for piece in pieces(batch.column("text")):
                yield _piece_counts(piece, ids, given, encode, rule)
        encode.clear()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, section int, start long, end long, n_tokens double, n_crossing long")


def _piece_counts(piece: Piece, ids: pa.Array, given: list, encode, rule: str) -> pa.RecordBatch:
    chars = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])
    row, parts = [], []
    for r, tokens in enumerate(encode.rows(piece)):
        low, high = int(piece.bounds[r]), int(piece.bounds[r + 1])
        own = given[piece.first + r]
        ends = _line_ends(piece.data[low:high]) if own is None else np.array(own, np.int64)
        counts, crossing = allocate(np.cumsum(encode.widths[tokens]), ends, rule)
        to = chars[low + ends] - chars[low]
        parts.append((np.arange(len(ends)), np.concatenate([[0], to[:-1]]), to, counts, crossing))
        row.append(np.full(len(ends), piece.first + r))
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
    arrays = [ids.take(pa.array(np.concatenate(row))), *(pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True))]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])


def line_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: str = "most", tokenizer: str = DEFAULT_FILE) -> DataFrame:
    """One row per line of each text: doc_id, section (from 0), start and end (characters), n_tokens, n_crossing."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.lit(None).cast("array<long>").alias("ends"))
    return _counted(rows, rule, tokenizer)


def field_counts(documents: DataFrame, fields: list[str], id_col: str = "doc_id", separator: str = "\n", rule: str = "most", tokenizer: str = DEFAULT_FILE) -> DataFrame:
    """One row per field: the fields are joined by ``separator``, which belongs to the field before it, and encoded as one text."""
    given = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    parts = [F.concat(x, F.lit(separator)) if i + 1 < len(given) else x for i, x in enumerate(given)]
    ends, total = [], F.lit(0)
    for part in parts:
        total = total + F.octet_length(part)
        ends.append(total.cast("long"))
    rows = documents.select(F.col(id_col).alias("doc_id"), F.concat(*parts).alias("text"), F.array(*ends).alias("ends"))
    named = F.element_at(F.array(*map(F.lit, fields)), F.col("section") + 1)
    return _counted(rows, rule, tokenizer).withColumn("field", named)
