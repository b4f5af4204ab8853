"""Token ids as Arrow files of equal-length sequences, for random access without a copy.

The ids of the documents, each followed by an end id, run on in ascending order of the document id. They are dealt
over shards by ranges of the id; a shard's ids are cut into sequences of ``length``, the last one filled up with
zeros. A shard is one Arrow IPC file with the columns ``ids`` (fixed-size list of uint16, or of uint32 where the
vocabulary is larger) and ``mask`` (fixed-size list of booleans: false for filling), ``BATCH_ROWS`` sequences a record
batch, and one with the documents' places.
The footer of the format says where each batch lies, so that sequence i is found without reading others, and a mapped
file hands out its numbers as they lie on the disk.

A task writes files with names of its own and reports them as a row; the stored rows are the manifest. Files of
attempts that failed are in no manifest, so lost executors and repeated tasks never change what is read.

Defined results: a null or empty text has the end id alone; a null id comes first; equal ids follow each other in
the order of their rows; an empty table makes no file and a manifest without rows; other columns are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortloom.llm.textbytes import pieces
from cohortloom.llm.words import word_encoder
from cohortloom.session import scratch_path

DEFAULT_FILE = "word_bpe_49k.json"
END_ID = 2
LENGTH = 2048
BATCH_ROWS = 64
#: Bytes of text that a shard is meant to hold, and the least for which another task is worth its while.
SHARD_BYTES = 64 << 20
LEAST_BYTES = 1 << 20
#: Bytes of text that are encoded at once: the more, the fewer words are new.
ENCODED_BYTES = 2 << 20

MANIFEST = "shard int, file string, places string, n_documents long, n_ids long, n_sequences long"


def sequence_schema(length: int, largest: int) -> pa.Schema:
    """``largest`` is the largest id. A sequence's mask fills whole bytes."""
    if length <= 0 or length % 8:
        raise ValueError("the length is a multiple of 8")
    return pa.schema([("ids", pa.list_(pa.uint16() if largest < 1 << 16 else pa.uint32(), length)), ("mask", pa.list_(pa.bool_(), length))])


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them as they fill."""

    def __init__(self, path: str, length: int, largest: int):
        self.length, self.schema = length, sequence_schema(length, largest)
        self.kind = self.schema.field("ids").type.value_type.to_pandas_dtype()
        system, place = _opened(path)
        self.sink = system.open_output_stream(place)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind))
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.length * BATCH_ROWS:
            flat = np.concatenate(self.held)
            whole = len(flat) // (self.length * BATCH_ROWS) * self.length * BATCH_ROWS
            for at in range(0, whole, self.length * BATCH_ROWS):
                self._write(flat[at : at + self.length * BATCH_ROWS], self.length * BATCH_ROWS)
            self.held, self.n_held = [flat[whole:]], len(flat) - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, np.arange(len(ids)) < real)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))
        self.n_sequences += len(ids) // self.length

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            filled = np.zeros(-(-len(flat) // self.length) * self.length, self.kind)
            filled[: len(flat)] = flat
            self._write(filled, len(flat))
        self.writer.close()
        self.sink.close()


class SequenceFile:
    """A written file: ``file[i]`` is the pair (ids, mask) of sequence i, as views of the file where it can be mapped.

    The mask comes as it lies there, eight places a byte, the first in the lowest bit: ``unpacked`` spreads it.
    """

    def __init__(self, path: str):
        system, place = _opened(path)
        self.source = pa.memory_map(place) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(place)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.batches = self.reader.num_record_batches
        self.n = (self.batches - 1) * BATCH_ROWS + self.reader.get_batch(self.batches - 1).num_rows if self.batches else 0

    def __len__(self) -> int:
        return self.n

    def batch(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and masks of batch ``i``, a row per sequence."""
        found = self.reader.get_batch(i)
        bits = np.frombuffer(found.column("mask").flatten().buffers()[1], np.uint8)[: found.num_rows * self.length // 8]
        return found.column("ids").flatten().to_numpy(zero_copy_only=True).reshape(-1, self.length), bits.reshape(-1, self.length // 8)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if not 0 <= i < self.n:
            raise IndexError(i)
        ids, mask = self.batch(i // BATCH_ROWS)
        return ids[i % BATCH_ROWS], mask[i % BATCH_ROWS]

    def run(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of one batch each."""
        width = self.length * BATCH_ROWS
        while n > 0:
            flat = self.batch(start // width)[0].reshape(-1)
            part = flat[start % width : start % width + n]
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self.source.close()


def unpacked(mask: np.ndarray) -> np.ndarray:
    """The mask of a sequence as booleans, one per place."""
    return np.unpackbits(mask, bitorder="little").astype(bool)


_PLACES = pa.schema([("doc_id", pa.string()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _writer(folder: str, length: int, file: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        encoder, out, sink, places, n_documents = word_encoder(file), None, None, None, 0
        paths = [f"{folder}/{shard:07d}-{name}.{kind}.arrow" for kind in ("sequences", "places")]
        for batch in batches:
            if out is None and batch.num_rows:
                out = SequenceWriter(paths[0], length, max(encoder.largest, end_id))
                system, place = _opened(paths[1])
                sink = system.open_output_stream(place)
                places = pa.ipc.new_file(sink, _PLACES)
            for piece in pieces(batch.column("text"), ENCODED_BYTES):
                ids, edges = encoder.encode(piece)
                sizes = np.diff(edges) + 1
                starts = out.n_ids + np.concatenate([[0], np.cumsum(sizes)[:-1]])
                out.add(np.insert(ids, edges[1:], end_id))
                own = batch.column("id").slice(piece.first, len(piece))
                places.write_batch(pa.RecordBatch.from_arrays([own, pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=_PLACES))
                n_documents += len(piece)
        if out is None:
            return
        out.close()
        places.close()
        sink.close()
        row = [pa.array([v], k) for v, k in zip((shard, *paths, n_documents, out.n_ids, out.n_sequences), (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays(row, ["shard", "file", "places", "n_documents", "n_ids", "n_sequences"])

    return write


def shards_for(spark: SparkSession, text_bytes: int) -> int:
    """Shards of about ``SHARD_BYTES`` of text, and on small tables enough for the cluster's tasks."""
    slots = 2 * spark.sparkContext.defaultParallelism
    return max(1, -(-text_bytes // SHARD_BYTES), min(slots, -(-text_bytes // LEAST_BYTES)))


class SequenceFiles:
    """A written set of files. ``manifest`` has one row per shard, with ``start``: the ids of all shards before it."""

    def __init__(self, spark: SparkSession, folder: str, id_type: str):
        self.spark, self.folder, self.id_type = spark, folder, id_type
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        # One row per shard, not per document: the one window without a key.
        self.manifest = spark.read.parquet(f"{folder}/manifest").withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))

    def _tasks(self) -> DataFrame:
        """The manifest's rows, dealt over tasks."""
        shards = self.manifest.count()
        return self.manifest.repartition(max(1, min(shards, 8 * self.spark.sparkContext.defaultParallelism)), "shard")

    def documents(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    file = SequenceFile(row["file"])
                    system, place = _opened(row["places"])
                    with system.open_input_file(place) as source:
                        places = pa.ipc.open_file(source)
                        for i in range(places.num_record_batches):
                            own = places.get_batch(i)
                            sums = []
                            for start, n in zip(own.column("start").to_pylist(), own.column("n_tokens").to_pylist(), strict=True):
                                crc = 0
                                for part in file.run(start, n):
                                    crc = zlib.crc32(part.astype("<u4"), crc)
                                sums.append(crc)
                            starts = pa.array(own.column("start").to_numpy() + row["start"], pa.int64())
                            yield pa.RecordBatch.from_arrays([own.column("doc_id"), starts, own.column("n_tokens"), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                    file.close()

        found = self._tasks().mapInArrow(read, "doc_id string, start long, n_tokens long, ids_crc32 long")
        return found.withColumn("doc_id", F.col("doc_id").cast(self.id_type))

    def sequences(self) -> DataFrame:
        """(shard, sequence, ids, mask): every sequence, as arrays."""

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    file = SequenceFile(row["file"])
                    for i in range(file.batches):
                        found = file.reader.get_batch(i)
                        n = found.num_rows
                        columns = [pa.array([row["shard"]] * n, pa.int32()), pa.array(np.arange(n, dtype=np.int64) + i * BATCH_ROWS)]
                        columns += [found.column("ids").cast(pa.list_(pa.int64())), found.column("mask").cast(pa.list_(pa.bool_()))]
                        yield pa.RecordBatch.from_arrays(columns, ["shard", "sequence", "ids", "mask"])
                    file.close()

        return self._tasks().mapInArrow(read, "shard int, sequence long, ids array<long>, mask array<boolean>")


def write_sequences(documents: DataFrame, folder: str | None = None, length: int = LENGTH, file: str = DEFAULT_FILE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> SequenceFiles:
    """Encodes and writes all documents below ``folder`` (a new one in the shared folder), which all executors must reach."""
    spark = documents.sparkSession
    folder = folder or scratch_path(spark, "sequences")
    id_type = documents.schema[id_col].dataType.simpleString()
    if shards is None:
        size = documents.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
        shards = shards_for(spark, size)
    system, place = _opened(folder)
    system.create_dir(place, recursive=True)
    # The place of the row settles equal ids, so that an id that holds a third of all rows is split too.
    rows = documents.select(F.col(id_col).alias("_order"), F.monotonically_increasing_id().alias("_tie"), F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.repartitionByRange(shards, F.asc("_order"), F.asc("_tie")).sortWithinPartitions("_order", "_tie").select("id", "text")
    dealt.mapInArrow(_writer(folder, length, file, end_id), MANIFEST).write.parquet(f"{folder}/manifest")
    return SequenceFiles(spark, folder, id_type)
