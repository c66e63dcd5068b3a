"""Token ids in Arrow files of equal-length sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.encode import encoded
from larder.llm.files import attempt_name, open_folder, spread
from larder.session import stage

LENGTH = 2048
BATCH = 64  # sequences


def schema(length: int) -> pa.Schema:
    """Ids and mask are fixed-size lists, so sequence i is a slice of one buffer.

    ``doc_ids`` and ``doc_starts`` name the documents that begin in a sequence.
    """
    return pa.schema(
        [
            ("ids", pa.list_(pa.uint16(), length)),
            ("mask", pa.list_(pa.bool_(), length)),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_starts", pa.list_(pa.int32())),
        ]
    )


def _record_batch(ids: np.ndarray, valid: int, docs: list, starts: np.ndarray, length: int):
    """Sequences from a flat run of ids; positions of ``docs`` are counted in that run."""
    count = len(ids) // length
    row = starts // length
    offsets = np.searchsorted(row, np.arange(count + 1)).astype("<i4")
    mask = np.arange(len(ids)) < valid
    form = schema(length)
    lists = [
        pa.FixedSizeListArray.from_arrays(pa.array(ids, pa.uint16()), length),
        pa.FixedSizeListArray.from_arrays(pa.array(mask, pa.bool_()), length),
        pa.ListArray.from_arrays(offsets, pa.array(docs, pa.int64())),
        pa.ListArray.from_arrays(offsets, pa.array((starts % length).astype("<i4"), pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(lists, schema=form)


class SequenceWriter:
    """Cuts a stream of documents into equal sequences and writes them batch by batch.

    The Arrow file format is the stream format with a footer that says where each record
    batch lies. Bodies are not compressed: a reader maps the file and slices.
    """

    def __init__(self, sink, length: int = LENGTH) -> None:
        self.length = length
        self.writer = pa.ipc.new_file(sink, schema(length))
        self.parts: list[bytes] = []
        self.held = 0  # ids not yet written
        self.docs: list = []
        self.starts: list[int] = []
        self.n_docs = self.n_tokens = 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.held)
        self.parts.append(raw)
        self.held += len(raw) // 2
        self.n_docs += 1
        self.n_tokens += len(raw) // 2
        if self.held >= BATCH * self.length:  # whole batches: place gives the batch of a sequence
            self._flush(self.held - self.held % (BATCH * self.length))

    def _flush(self, count: int) -> None:
        ids = np.frombuffer(b"".join(self.parts), "<u2")
        starts = np.array(self.starts, "<i8")
        now = int(np.searchsorted(starts, count))
        for low in range(0, count, BATCH * self.length):
            high = min(count, low + BATCH * self.length)
            a, b = np.searchsorted(starts, [low, high])
            part = ids[low:high]
            padded = np.zeros(-(-len(part) // self.length) * self.length, "<u2")
            padded[: len(part)] = part
            self.writer.write_batch(
                _record_batch(padded, len(part), self.docs[a:b], starts[a:b] - low, self.length)
            )
        self.parts = [ids[count:].tobytes()]
        self.held -= count
        self.docs = self.docs[now:]
        self.starts = (starts[now:] - count).tolist()

    def close(self) -> None:
        if self.held:
            self._flush(self.held)
        self.writer.close()


def write_sequences(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
) -> DataFrame:
    """Write the documents in ascending id order; the manifest: task, file, n_docs, n_tokens.

    A document is the ids of its text and ``end_id``; NULL and empty texts are that id
    alone. NULL ids come first; rows under one id are ordered by a hash of their text. Each
    task writes one file of whole documents over its own range of ids; its last sequence is
    padded with 0 under a mask. Only files of the manifest count: a lost or repeated task
    attempt leaves a file that nothing names. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    end = np.array([end_id], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        name = attempt_name("sequences") + ".arrow"
        out = None
        for batch, texts in encoded(batches, tokenizer):
            for number, raw in zip(batch.column("doc_id").to_pylist(), texts):
                if out is None:
                    sink = system.open_output_stream(f"{path}/{name}")
                    out = SequenceWriter(sink, length)
                out.add(number, raw + end)
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "task": TaskContext.get().partitionId(),
                        "file": name,
                        "n_docs": out.n_docs,
                        "n_tokens": out.n_tokens,
                    }
                ]
            )

    order = ["doc_id", "tie", "place"]
    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("tie"),
        F.monotonically_increasing_id().alias("place"),
    )
    manifest = (
        narrow.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(run, "task bigint, file string, n_docs bigint, n_tokens bigint")
    )
    return stage(manifest, "manifest")


def read_sequences(system, path: str) -> Iterator[tuple[np.ndarray, int, list, np.ndarray]]:
    """(ids, valid, doc_ids, doc_starts) of each record batch; ids are a view of the file."""
    with system.open_input_file(path) as source:
        reader = pa.ipc.open_file(source)
        for number in range(reader.num_record_batches):
            batch = reader.get_batch(number)
            length = batch.schema.field("ids").type.list_size
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
            valid = batch.column("mask").flatten().true_count
            starts = batch.column("doc_starts")
            row = np.repeat(np.arange(len(batch)), starts.value_lengths().to_numpy())
            yield (
                ids,
                valid,
                batch.column("doc_ids").flatten().to_pylist(),
                row * length + starts.flatten().to_numpy(zero_copy_only=False),
            )


def open_for_slices(system, path: str):
    """A mapped file where the store is this machine's, else one read through the store."""
    if isinstance(system, pa.fs.LocalFileSystem):
        return pa.memory_map(path)
    return system.open_input_file(path)


def sequence(system, path: str, number: int, batch_size: int = BATCH):
    """(ids, mask) of one sequence of a file, by its place from 0.

    Every batch of a file but the last has ``batch_size`` sequences, so the place says which
    batch holds it, and only that is read. From a mapped file the arrays are views of it. A
    place beyond the file raises IndexError.
    """
    with open_for_slices(system, path) as source:
        reader = pa.ipc.open_file(source)
        at, row = divmod(number, batch_size)
        if number < 0 or at >= reader.num_record_batches:
            raise IndexError(f"{path} has no sequence {number}")
        batch = reader.get_batch(at)
        if row >= batch.num_rows:
            raise IndexError(f"{path} has no sequence {number}")
        return batch.column("ids")[row].values, batch.column("mask")[row].values


def document_digests(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        for batch in batches:
            for entry in batch.to_pylist():
                yield from digest(system, f"{path}/{entry['file']}", entry["base"])

    def digest(system, file: str, base: int) -> Iterator[pa.RecordBatch]:
        position = base
        doc, start, crc = None, base, 0
        rows: list[tuple] = []
        began = False
        for ids, valid, docs, starts in read_sequences(system, file):
            edges = [*starts.tolist(), valid]
            # What lies before the first start belongs to the document before.
            crc = zlib.crc32(ids[: edges[0]].astype("<u4").tobytes(), crc)
            for number, low, high in zip(docs, edges, edges[1:]):
                if began:
                    rows.append((doc, start, position + low - start, crc))
                doc, start, began = number, position + low, True
                crc = zlib.crc32(ids[low:high].astype("<u4").tobytes())
            position += valid
            if len(rows) >= 10_000:
                yield _digest_batch(rows)
                rows = []
        if began:
            rows.append((doc, start, position - start, crc))
            yield _digest_batch(rows)

    order = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(
        "file", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("base")
    )
    return spread(files, spark).mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*rows)], names=names
    )
