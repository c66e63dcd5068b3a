"""Document lengths from flat token files, by scanning for separators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.encode import encoded
from larder.llm.files import attempt_name, open_folder, spread
from larder.session import stage

BLOCK_BYTES = 8 << 20


def write_flat(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write token ids one after the other, ``end_id`` after each document, without an index.

    Every task writes one file of unsigned 16-bit little-endian ids as it reads, so nothing
    is shuffled. The strings of special tokens are encoded as ordinary text, so that
    ``end_id`` cannot come from a text. Returns which document stands where:
    (file, ordinal, doc_id); files it does not name (of lost attempts) do not count.
    """
    end = np.array([end_id], "<u2").tobytes()
    form = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        name = attempt_name("tokens") + ".bin"
        ordinal, sink = 0, None
        for batch, texts in encoded(batches, tokenizer, plain=True):
            if not texts:
                continue
            if sink is None:
                sink = system.open_output_stream(f"{path}/{name}")
            for raw in texts:
                sink.write(raw)
                sink.write(end)
            numbers = range(ordinal, ordinal + len(texts))
            ordinal += len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(texts)), pa.array(numbers, pa.int64()), batch.column("doc_id")],
                schema=form,
            )
        if sink is not None:
            sink.close()

    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")
    )
    written = narrow.mapInArrow(run, "file string, ordinal bigint, doc_id bigint")
    return stage(written, "token-order")


def scan_blocks(
    spark: SparkSession, folder: str, end_id: int, width: int, block_bytes: int
) -> DataFrame:
    """(file, block, first, tokens, ends): where separators stand in each block of each file."""
    block_bytes -= block_bytes % width
    listed = spark.read.format("binaryFile").load(f"{folder}/*.bin").select("path", "length")
    blocks = listed.where(F.col("length") >= width).select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        "length",
        F.explode(F.sequence(F.lit(0), F.col("length") - width, F.lit(block_bytes))).alias("low"),
    )
    kind = f"<u{width}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                size = min(block_bytes, row["length"] - row["low"])
                size -= size % width
                with system.open_input_file(f"{path}/{row['file']}") as source:
                    ids = np.frombuffer(source.read_at(size, row["low"]), kind)
                first = row["low"] // width
                ends = np.flatnonzero(ids == end_id) + first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]]),
                        pa.array([first], pa.int64()),
                        pa.array([len(ids)], pa.int64()),
                        pa.array([ends], pa.list_(pa.int64())),
                    ],
                    names=["file", "first", "tokens", "ends"],
                )

    return spread(blocks, spark).mapInArrow(
        run, "file string, first bigint, tokens bigint, ends array<bigint>"
    )


def count_tokens(
    spark: SparkSession, folder: str, end_id: int, width: int = 2, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document of flat token files: file, ordinal, start, n_tokens, closed.

    Blocks are scanned on their own; a scan over the block summaries of a file (how many
    separators, where the last one is) then gives each block the number of documents
    before it and where its first document began, however many blocks that document
    covers. ``n_tokens`` is without the separator; two separators in a row are an empty
    document. Tokens after the last separator of a file are a document with ``closed``
    false. Empty files give no rows.
    """
    scanned = stage(scan_blocks(spark, folder, end_id, width, block_bytes), "ends")
    earlier = (
        Window.partitionBy("file").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    )
    last = F.element_at("ends", F.when(F.size("ends") > 0, -1))
    stitched = (
        scanned.withColumn("last", last)
        .withColumns(
            {
                "docs_before": F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)),
                "end_before": F.coalesce(F.max("last").over(earlier), F.lit(-1)),
                "is_last": F.lead("first").over(Window.partitionBy("file").orderBy("first")).isNull(),
            }
        )
        .withColumn("limit", F.col("first") + F.col("tokens"))
        .withColumn(
            "open",
            F.col("is_last") & (F.coalesce("last", "end_before") + 1 < F.col("limit")),
        )
        .withColumn(
            "edges",
            F.concat(
                F.array("end_before"),
                "ends",
                F.when(F.col("open"), F.array("limit")).otherwise(F.array().cast("array<bigint>")),
            ),
        )
    )
    place = F.posexplode(F.slice("edges", 2, F.size("edges") - 1)).alias("k", "end")
    rows = stitched.select("file", "docs_before", "edges", "open", F.size("ends").alias("n"), place)
    start = F.get("edges", F.col("k")) + 1
    return rows.select(
        "file",
        (F.col("docs_before") + F.col("k")).alias("ordinal"),
        start.alias("start"),
        (F.col("end") - start).alias("n_tokens"),
        (F.col("k") < F.col("n")).alias("closed"),
    )


def token_counts(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Tokens of every document, by writing flat token files and counting in them.

    Result: id, n_tokens (without the separator), start (in its file). NULL and empty texts
    have 0 tokens; NULL and repeated ids are documents of their own; other columns are not
    read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    written = write_flat(docs, folder, tokenizer, end_id, id_col, text_col)
    if written.isEmpty():
        counts = spark.createDataFrame([], "file string, ordinal bigint, start bigint, n_tokens bigint")
    else:
        counts = count_tokens(spark, folder, end_id, 2, block_bytes)
    return written.join(counts, ["file", "ordinal"]).select(
        F.col("doc_id").alias(id_col), "n_tokens", "start"
    )
