"""Benchmark decontamination: documents are scanned once against a broadcast set of test n-grams.

Words are lower-cased runs of digits, letters a-z and characters outside ASCII. A window is
``size`` consecutive words of a benchmark item; a shorter item is one window, an item without
words has none. Windows are looked up by hash and each hit is then verified word by word.

Defined results: a null or empty text has no words and no hits; a repeated row is answered each
time; an empty benchmark hits nothing; an item whose id is null cannot be named: its windows are hits
and remove documents, but are not among the items, nor cut out as spans; columns of the caller's tables besides the id and the text are never read, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortloom.llm.textbytes import ALPHANUMERIC, Piece, covered, pieces, run_hashes
from cohortloom.session import scratch_path

WINDOW_WORDS = 10
#: Windows broadcast at once (about 150 bytes each); a larger benchmark is scanned in slices.
SLICE_WINDOWS = 1_000_000

Known = dict[int, dict[int, dict[bytes, list[str]]]]


def _words(piece: Piece):
    low = piece.lowered()
    starts, ends, rows = low.spans(ALPHANUMERIC)
    return low, starts, ends, rows, low.hashes(starts, ends)


def _joined(piece: Piece, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b" ".join(piece.data[a:b].tobytes() for a, b in zip(starts, ends, strict=True))


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW_WORDS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, window, n_words); the window is its words joined by a space. The item may be null."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item").to_pylist()
            for piece in pieces(batch.column("text")):
                low, starts, ends, rows, _ = _words(piece)
                edges = np.searchsorted(rows, np.arange(len(piece) + 1))
                out: list[tuple[str, bytes, int]] = []
                for row, (first, last) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    long = min(size, last - first)
                    if not long:
                        continue
                    for at in range(first, last - long + 1):
                        out.append((ids[piece.first + row], _joined(low, starts[at : at + long], ends[at : at + long]), long))
                if out:
                    kinds = (pa.string(), pa.binary(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["item", "window", "n_words"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(windows, "item string, window binary, n_words long").distinct()


def _slices(windows: DataFrame, most: int) -> Iterator[Known]:
    """The windows in parts of bounded size, by the hash of the window."""
    total = windows.count()
    parts = max(1, -(-2 * total // most)) if total > most else 1
    for part in range(parts):
        known: Known = {}
        own = windows if parts == 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)
        texts: dict[tuple[int, bytes], list[str]] = {}
        for row in own.toLocalIterator():
            texts.setdefault((row["n_words"], bytes(row["window"])), []).append(row["item"])
        for (size, text), items in texts.items():
            _, _, _, rows, words = _words(Piece(0, np.frombuffer(text, np.uint8), np.array([0, len(text)])))
            _, key = run_hashes(words, rows, size)
            known.setdefault(size, {}).setdefault(int(key[0]), {})[text] = items
        yield known


class Scanner:
    """Finds the windows of one slice in pieces of text."""

    def __init__(self, known: Known):
        self.known = known
        self.keys = {n: np.sort(np.fromiter(x, np.uint64, len(x))) for n, x in known.items()}
        self.sieve = {}
        for n, keys in self.keys.items():
            bits = np.zeros(1 << 22, bool)
            bits[keys >> np.uint64(42)] = True
            self.sieve[n] = bits

    def scan(self, piece: Piece):
        """Words of the piece (starts, ends, rows), a flag for each word, and the items of each row."""
        low, starts, ends, rows, words = _words(piece)
        hit = np.zeros(len(words), bool)
        items: dict[int, set[str]] = {}
        for size, keys in self.keys.items():
            at, found = run_hashes(words, rows, size)
            maybe = np.flatnonzero(self.sieve[size][found >> np.uint64(42)])
            at, found = at[maybe], found[maybe]
            place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            same = keys[place] == found
            sure = []
            for start, key in zip(at[same].tolist(), found[same].tolist(), strict=True):
                named = self.known[size][key].get(_joined(low, starts[start : start + size], ends[start : start + size]))
                if named is not None:
                    sure.append(start)
                    items.setdefault(int(rows[start]), set()).update(x for x in named if x is not None)
            if sure:
                hit |= covered(np.array(sure), size, len(words))
        return starts, ends, rows, hit, items


_NOTE = "struct<n_words:long,n_hit:long,items:array<string>,spans:array<struct<start:long,end:long>>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _notes(piece: Piece, scanner: Scanner, earlier: list[dict] | None) -> pa.Array:
    """What the rows of a piece hold: counts, items, and the hit words as byte ranges."""
    starts, ends, rows, hit, items = scanner.scan(piece)
    edge = np.searchsorted(rows, np.arange(len(piece) + 1))
    out = []
    for r, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
        named, flags = items.get(r, set()), hit[a:b]
        at, to = starts[a:b] - piece.bounds[r], ends[a:b] - piece.bounds[r]
        if earlier is not None and earlier[r]["n_hit"]:
            named = named | set(earlier[r]["items"])
            for span in earlier[r]["spans"]:
                flags = flags | ((at >= span["start"]) & (to <= span["end"]))
        spans = []
        if flags.any():
            turn = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
            spans = [{"start": int(at[x]), "end": int(to[y - 1])} for x, y in zip(turn[::2], turn[1::2], strict=True)]
        out.append({"n_words": b - a, "n_hit": int(flags.sum()), "items": sorted(named), "spans": spans})
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))])
    return pa.array(out, kind)


def annotate(documents: DataFrame, windows: DataFrame, text_col: str = "text", into: str = "contamination", slice_windows: int = SLICE_WINDOWS, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) plus a struct of n_words, n_hit, items (sorted) and spans (UTF-8 byte ranges).

    A benchmark of up to ``slice_windows`` windows is scanned in one pass. A larger one takes one
    pass for each slice, with a written table between passes, so that what is broadcast and held
    stays bounded and no window is left out.
    """
    spark = documents.sparkSession
    keep = [c for c in documents.columns if c != into] if keep is None else keep
    out, first = documents, True
    for known in _slices(windows, slice_windows):
        if not first:
            path = scratch_path(spark, "contamination")
            out.write.parquet(path)
            out = spark.read.parquet(path)
        names = list(dict.fromkeys([*keep, text_col]))
        fields = [out.schema[c] for c in names]
        shared = spark.sparkContext.broadcast(known)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, width=len(names), at=names.index(text_col), first=first) -> Iterator[pa.RecordBatch]:
            scanner = Scanner(shared.value)
            for batch in batches:
                for piece in pieces(batch.column(at)):
                    own = batch.slice(piece.first, len(piece))
                    earlier = None if first else own.column(width).to_pylist()
                    arrays = [*own.columns[:width], _notes(piece, scanner, earlier)]
                    yield pa.RecordBatch.from_arrays(arrays, [*own.schema.names[:width], into])

        schema = T.StructType([*fields, T.StructField(into, T._parse_datatype_string(_NOTE))])
        out = out.select(*names, *([] if first else [into])).mapInArrow(scan, schema)
        first = False
    return out


def find_contamination(documents: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items, spans, as ``annotate`` gives them."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return annotate(docs, windows, slice_windows=slice_windows).select("doc_id", "contamination.*")


def digest(found: DataFrame) -> DataFrame:
    """The report columns of ``find_contamination``."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _without(text: str | None, spans: list[dict]) -> str | None:
    if not spans:
        return text
    raw, kept, at = text.encode(), [], 0
    for span in spans:
        kept.append(raw[at : span["start"]])
        at = span["end"]
    return b"".join([*kept, raw[at:]]).decode()


def decontaminate(documents: DataFrame, windows: DataFrame, remove: str = "documents", text_col: str = "text", slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """The documents without those that hold a window, or (``remove="spans"``) without the words that named items hit.

    All columns stay as they are; a null text stays null.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    into = "contamination"
    while into in documents.columns:
        into += "_"
    if remove == "spans":
        windows = windows.where("item is not null")
    found = annotate(documents, windows, text_col, into, slice_windows)
    if remove == "documents":
        return found.where(F.col(f"{into}.n_hit") == 0).select(*documents.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, spans = batch.schema.names.index(text_col), batch.column(into).field("spans").to_pylist()
            texts = [_without(t, s) for t, s in zip(batch.column(at).to_pylist(), spans, strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)).drop_columns([into])

    return found.mapInArrow(cut, T.StructType([f for f in found.schema.fields if f.name != into])).select(*documents.columns)
