"""Pairs of texts that share most of their runs of words: candidate buckets, then exact sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from larder.llm.buckets import block_pairs, map_cells
from larder.llm.components import smallest_links

SEED = 42
# The band of buckets that are groups of near fingerprints.
NEAR = -1
# Texts whose sets are compared in one task at a time: two blocks.
BLOCK = 512
STRIP = 1 << 14


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Distinct XXH64 hashes of all runs of ``shingle`` words, ascending.

    Words are what white space separates, A-Z in lower case; a text with fewer words is one
    run, a text without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    shingle = min(shingle, len(words))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    return np.array(sorted({xxh64_intdigest(line[a:b], SEED) for a, b in spans}), np.uint64)


def band_values(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number per band from ``rows`` MinHashes of a set each.

    Sets of Jaccard similarity s agree in a band with probability s ** rows, whatever their
    sizes.
    """
    rng = np.random.default_rng([SEED, bands * rows])
    turn = rng.integers(0, 1 << 64, (bands * rows, 1), np.uint64)
    factor = rng.integers(0, 1 << 64, (bands * rows, 1), np.uint64) | np.uint64(1)
    lowest = np.full(bands * rows, np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for start in range(0, len(hashes), STRIP):
            mixed = (hashes[start : start + STRIP] ^ turn) * factor
            lowest = np.minimum(lowest, mixed.min(axis=1))
        values = np.zeros(bands, np.uint64)
        for column in lowest.reshape(bands, rows).T:
            values = (values ^ column) * np.uint64(0x9E3779B97F4A7C15)
            values ^= values >> np.uint64(32)
    return values


def with_bands(
    texts: DataFrame, shingle: int, bands: int, rows: int, mark: Callable[[np.ndarray], int]
) -> DataFrame:
    """``texts`` (narrow columns, the text last) with ``digest`` (of the set of runs), ``fp0``
    (``mark`` of the set, 64 bits) and ``bands`` instead of the text."""
    kept = texts.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, marks, values = [], [], []
            for text in batch.column(len(kept)):
                hashes = shingle_set(text.as_py(), shingle)
                digests.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                marks.append(mark(hashes))
                values.append(band_values(hashes, bands, rows).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(kept)],
                    pa.array(digests, pa.binary()),
                    pa.array(np.array(marks, np.uint64).view(np.int64)),
                    pa.array(values, pa.list_(pa.int64())),
                ],
                names=[*kept, "digest", "fp0", "bands"],
            )

    kinds = [f"`{name}` {kind}" for name, kind in texts.dtypes[:-1]]
    return texts.mapInArrow(run, ", ".join([*kinds, "digest binary", "fp0 bigint", "bands array<bigint>"]))


def with_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"]
            )

    return texts.select("node", "text").mapInArrow(run, "node bigint, shingles array<bigint>")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(bucket, node) of all buckets of two or more nodes.

    ``nodes`` has node, near (its group of near fingerprints) and bands. A group is a bucket;
    buckets of a band inside one group hold no further pair and are left out. Near copies meet
    in many bands; buckets with the same members (by number, smallest node and two checksums)
    are kept once.
    """
    members = nodes.select("node", "near", F.posexplode("bands").alias("band", "value")).union(
        nodes.select("node", "near", F.lit(NEAR), "near")
    )
    sums = [
        F.sum(F.xxhash64("node", F.lit(seed)).cast("decimal(38,0)")).alias(f"sum{seed}")
        for seed in (1, 2)
    ]
    shared = (
        members.groupBy("band", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("node").alias("low"),
            (F.min("near") < F.max("near")).alias("mixed"),
            *sums,
        )
        .where((F.col("n") > 1) & (F.col("mixed") | (F.col("band") == NEAR)))
    )
    once = shared.groupBy("n", "low", "sum1", "sum2").agg(F.min(F.struct("band", "value")).alias("bucket"))
    return members.join(once.select("bucket.*"), ["band", "value"]).select(
        F.struct("band", "value").alias("bucket"), "node"
    )


def link_cells(
    cells: np.ndarray, rows: pa.RecordBatch, similarity: float
) -> Iterator[pa.RecordBatch]:
    """Star links (a, b) of what is connected inside each cell by pairs of ``similarity``."""
    sides = rows.column("side").to_numpy()
    sets = rows.column("shingles")
    edges = np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())])
    hashes = sets.flatten().to_numpy()
    cuts = np.flatnonzero(np.diff(cells)) + 1
    found_a, found_b = [], []
    for low, high in zip([0, *cuts], [*cuts, len(cells)]):
        if high - low < 2:
            continue
        a, b = similar(
            hashes[edges[low] : edges[high]], edges[low : high + 1] - edges[low], sides[low:high], similarity
        )
        found_a.append(a + low)
        found_b.append(b + low)
    if found_a:
        nodes = rows.column("node").to_numpy()
        yield from smallest_links(nodes, np.concatenate(found_a), np.concatenate(found_b))


def similar(
    hashes: np.ndarray, edges: np.ndarray, sides: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect sets as all pairs of ``similarity`` would.

    Set i is ``hashes[edges[i]:edges[i + 1]]``. If both sides occur, sets of side 0 are
    compared with those of side 1, otherwise all with all. Sets that are connected already
    are not compared again.
    """
    sizes = np.diff(edges)
    names, places = np.unique(hashes, return_inverse=True)
    mark = np.zeros(len(names), np.int64)
    label = np.arange(len(sizes))
    two_sided = bool(sides.any()) and not sides.all()
    found_a, found_b = [], []
    for i in np.flatnonzero(sides == 0) if two_sided else range(len(sizes)):
        rest = label != label[i]
        if two_sided:
            rest &= sides == 1
        else:
            rest[:i] = False
        # The smaller of two sets cannot share more than itself.
        rest &= np.minimum(sizes, sizes[i]) >= (similarity - 1e-9) * np.maximum(sizes, sizes[i])
        rest = np.flatnonzero(rest)
        if not len(rest):
            continue
        mine = places[edges[i] : edges[i + 1]]
        mark[mine] = 1
        spans = [places[edges[j] : edges[j + 1]] for j in rest]
        lengths = sizes[rest]
        totals = np.concatenate([[0], np.cumsum(mark[np.concatenate(spans)])])
        ends = np.cumsum(lengths)
        shared = totals[ends] - totals[ends - lengths]
        mark[mine] = 0
        union = sizes[i] + lengths - shared
        hits = rest[shared / np.maximum(union, 1) >= similarity]
        if len(hits):
            found_a.append(np.full(len(hits), i))
            found_b.append(hits)
            joined = np.append(label[hits], label[i])
            label[np.isin(label, joined)] = joined.min()
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def link_sets(cells: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of the nodes that meet in ``cells`` (from ``block_pairs``)."""

    def work(number: np.ndarray, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        return link_cells(number, rows, similarity)

    return map_cells(
        cells.join(sets, "node"), ["side", "node", "shingles"], work, "a bigint, b bigint"
    )


def cells_of(nodes: DataFrame) -> DataFrame:
    """The members of shared buckets, dealt to cells of bounded size."""
    return block_pairs(bucket_members(nodes), "bucket", "node", BLOCK)
