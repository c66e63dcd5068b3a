"""Work on the members of buckets in bounded blocks, whatever the size of a bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import stage

BLOCK = 4096


def block_pairs(members: DataFrame, key: str, order: str, block: int = BLOCK) -> DataFrame:
    """Members dealt so that any two of a bucket meet in exactly one group.

    Adds ``cell``, a group of at most two blocks, and ``side``: 0 for the only block of a
    bucket or the first of a pair, 1 for the second. A bucket of n blocks makes n cells of
    one block and a cell per pair of blocks; buckets that fit one block, nearly all, are
    not multiplied. Members are dealt to blocks by a hash, so no bucket is sorted or held
    in one task; blocks are about ``block`` rows.
    """
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    # Few buckets are large: usually this table is small enough for a broadcast, decided by
    # its size; otherwise the join is one that adaptive execution splits.
    large = stage(sizes.where(F.col("n") > block), "large-buckets")
    joined = members.join(large, key, "left")
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(order, F.lit(11)), blocks).cast("int").alias("own")
    dealt = joined.select(*members.columns, blocks.alias("blocks"), own)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    return dealt.withColumn("other", F.explode(every)).select(
        *members.columns,
        F.struct(
            F.col(key),
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
        ).alias("cell"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )


def map_cells(
    members: DataFrame,
    columns: list[str],
    work: Callable[[np.ndarray, pa.RecordBatch], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Run ``work`` on the rows of whole cells, many small cells at a time.

    Rows are brought together and sorted by cell, which Spark does beyond memory. ``work``
    gets the number of the cell of each row, ascending, and the rows; a batch holds all
    rows of its cells. A task holds no more than one Arrow batch and one cell.
    """
    number = F.xxhash64("cell.*")  # only for the order; cells are told apart by value
    sorted_rows = (
        members.repartition("cell")
        .withColumn("number", number)
        .sortWithinPartitions("number", "cell")
        .select("cell", *columns)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            start = _cell_starts(whole.column("cell"))
            cut = start[-1]  # the last cell may go on in the next batch
            if cut:
                yield from emit(whole.slice(0, cut), start[start < cut])
                held = [whole.slice(cut)]
        if held:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield from emit(whole, _cell_starts(whole.column("cell")))

    def emit(rows: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        number = np.zeros(rows.num_rows, np.int64)
        number[starts[1:]] = 1
        yield from work(np.cumsum(number), rows)

    return sorted_rows.mapInArrow(run, schema)


def _fields(column: pa.Array) -> list[pa.Array]:
    if isinstance(column, pa.StructArray):
        return [leaf for part in column.flatten() for leaf in _fields(part)]
    return [column]


def _cell_starts(cells: pa.StructArray) -> np.ndarray:
    """Rows at which the cell differs from the row before."""
    changed = np.zeros(len(cells), bool)
    changed[:1] = True
    for part in _fields(cells):
        changed[1:] |= np.asarray(pc.not_equal(part[1:], part[:-1]))
    return np.flatnonzero(changed)
