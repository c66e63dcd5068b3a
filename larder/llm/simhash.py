"""SimHash near-duplicates by a generalised pigeonhole search in Hamming space."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from larder.llm.buckets import block_pairs, map_cells
from larder.llm.components import components, labels, smallest_links
from larder.llm.rows import keyed, rows_in
from larder.llm.shingles import cells_of, link_sets, with_bands, with_sets
from larder.session import stage

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
PART_COUNTS = (2, 3, 4, 5, 6, 7, 8)
MAX_PART_DISTANCE = 4
# What a bucket entry costs against comparing two fingerprints in memory.
ENTRY_COST = 250.0
CHUNK = 1 << 16


# -- fingerprints ------------------------------------------------------------------


def _lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Further hashes from given ones: lane 0 is the hash, others are mixed anew."""
    if not lane:
        return hashes
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(lane * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(
    text: str | None, shingle: int = SHINGLE, seed: int = SEED, lanes: int = 1
) -> list[int]:
    """SimHash of a whole text, 64 bits per lane, unsigned.

    Words are what white space (space, tab to carriage return) separates, A-Z in lower case;
    every run of ``shingle`` words, repeats included, is hashed with XXH64; a text with fewer
    words is one shingle. A bit is set if it is set in more than half of the hashes. NULL
    and texts without words have fingerprint 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return [0] * lanes
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    shingle = min(shingle, len(words))
    starts, ends = starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    counts = np.zeros((lanes, BITS), np.int64)
    for low in range(0, len(starts), CHUNK):
        spans = zip(starts[low : low + CHUNK], ends[low : low + CHUNK])
        hashes = np.array([xxh64_intdigest(line[a:b], seed) for a, b in spans], "<u8")
        for lane in range(lanes):
            raw = _lane(hashes, lane).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little")
            counts[lane] += bits.sum(axis=0, dtype=np.int64)
    marks = np.packbits(2 * counts > len(starts), axis=1, bitorder="little")
    return marks.view("<u8").ravel().tolist()


def set_fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a set of hashed runs, 64 bits, unsigned; 0 of an empty set.

    A run counts once, however often a text repeats it: a bit is set if it is set in more than
    half of the hashes.
    """
    counts = np.zeros(BITS, np.int64)
    for low in range(0, len(hashes), CHUNK):
        raw = hashes[low : low + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def lane_names(lanes: int) -> list[str]:
    return [f"fp{i}" for i in range(lanes)]


def with_fingerprints(texts: DataFrame, shingle: int = SHINGLE, lanes: int = 1) -> DataFrame:
    """``texts`` (narrow columns, the text last) with fp0, fp1, ... instead of the text."""
    kept = texts.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_here = batch.column(len(kept)).to_pylist()
            marks = np.array(
                [fingerprint(t, shingle, lanes=lanes) for t in texts_here], np.uint64
            ).reshape(-1, lanes)
            signed = [pa.array(np.ascontiguousarray(marks[:, i]).view(np.int64)) for i in range(lanes)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], *signed], names=[*kept, *lane_names(lanes)]
            )

    kinds = [f"`{name}` {kind}" for name, kind in texts.dtypes[:-1]]
    marks = [f"{name} bigint" for name in lane_names(lanes)]
    return texts.mapInArrow(run, ", ".join([*kinds, *marks]))


# -- the search plan ---------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Bits of each part and the distance searched in it (-1: the part is not probed)."""

    parts: tuple[tuple[int, ...], ...]
    distances: tuple[int, ...]
    cost: float

    def masks(self) -> list[int]:
        """Bits on which fingerprints of a bucket agree, signed: a bucket table per mask."""
        found = []
        for part, distance in zip(self.parts, self.distances):
            if distance >= 0:
                for free in combinations(part, distance):
                    mask = sum(1 << b for b in part if b not in free)
                    found.append(mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask)
        return found


def bit_statistics(nodes: DataFrame, lanes: list[str]) -> tuple[int, np.ndarray]:
    """How many nodes there are, and how often two bits of a lane are set together, over all."""
    size = len(lanes) * BITS * BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = np.zeros((len(lanes), BITS, BITS))
        for batch in batches:
            for lane, column in enumerate(batch.columns):
                raw = column.to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
                together[lane] += bits.T @ bits
        yield pa.RecordBatch.from_arrays(
            [pa.array([together.ravel().astype(np.int64)], pa.list_(pa.int64()))], names=["t"]
        )

    total = nodes.count()
    cells = nodes.select(*lanes).mapInArrow(run, "t array<bigint>").select(F.posexplode("t"))
    together = np.zeros(size)
    for row in cells.groupBy("pos").agg(F.sum("col").alias("n")).collect():  # 4,096 a lane
        together[row["pos"]] = row["n"]
    return total, together.reshape(len(lanes), BITS, BITS)


def _group(ties: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in parts of near-equal width, each grown from its strongest tie."""
    left, groups = set(range(BITS)), []
    for number in range(parts):
        width = len(left) // (parts - number)
        rest = sorted(left)
        pair = max(combinations(rest, 2), key=lambda p: ties[p]) if len(rest) > 1 else rest
        group = list(pair)[:width]
        while len(group) < width:
            rest = sorted(left.difference(group))
            group.append(max(rest, key=lambda b: ties[b, group].sum()))
        left.difference_update(group)
        groups.append(sorted(group))
    return groups


def choose_plan(total: int, together: np.ndarray, distance: int = DISTANCE) -> Plan:
    """The cheapest complete search for pairs within ``distance`` bits.

    By the generalised pigeonhole principle, if parts are searched for distances d with
    sum(d + 1) = distance + 1, every pair within ``distance`` is within d in some part.
    Correlated bits are put into one part, which keeps the parts nearly independent. The
    candidates of a part are estimated from how often its bits agree by chance (pairs of
    tied bits counted along a spanning tree); for each number of parts dynamic programming
    allots the distances that cost least, bucket entries and comparisons together.
    """
    share = np.diag(together) / max(total, 1)
    both = together / max(total, 1)
    only = share[:, None] - both
    neither = 1 - share[:, None] - share[None, :] + both
    agree = share**2 + (1 - share) ** 2
    agree_both = both**2 + only**2 + only.T**2 + neither**2
    lift = np.log(np.maximum(agree_both, 1e-9) / np.maximum(agree[:, None] * agree[None, :], 1e-9))
    np.fill_diagonal(lift, 0)
    pairs = total * (total - 1) / 2

    def cost(part: list[int], d: int) -> float:
        if d < 0:
            return 0.0
        inside = {part[0]}
        tied = 0.0
        while len(inside) < len(part):  # the spanning tree of the strongest ties
            gain, new = max((lift[a, b], b) for a in inside for b in part if b not in inside)
            tied += gain
            inside.add(new)
        chance = agree[part].prod() * math.exp(tied)
        by_free = [1.0] + [0.0] * d  # sums over the choices of bits that may differ
        for b in part:
            for k in range(d, 0, -1):
                by_free[k] += by_free[k - 1] / agree[b]
        return total * math.comb(len(part), d) * ENTRY_COST + pairs * min(1.0, chance) * by_free[d]

    best = None
    for count in PART_COUNTS:
        parts = _group(np.abs(lift), count)
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for part in parts:
            steps = {d: cost(part, d) for d in range(-1, MAX_PART_DISTANCE + 1)}
            after: dict[int, tuple[float, tuple[int, ...]]] = {}
            for used, (so_far, chosen) in table.items():
                for d, price in steps.items():
                    key, value = used + d + 1, (so_far + price, (*chosen, d))
                    if key <= distance + 1 and (key not in after or value < after[key]):
                        after[key] = value
            table = after
        if distance + 1 in table:
            price, chosen = table[distance + 1]
            if best is None or price < best.cost:
                best = Plan(tuple(map(tuple, parts)), chosen, price)
    return best


# -- links -------------------------------------------------------------------------


def link_cells(
    cells: np.ndarray, rows: pa.RecordBatch, lanes: list[str], limit: int, small: int = 64
) -> Iterator[pa.RecordBatch]:
    """Star links (a, b) of what is connected inside each cell of ``rows``.

    Nodes are linked if all lanes together differ in at most ``limit`` bits.
    """
    marks = [rows.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in lanes]
    sides = rows.column("side").to_numpy()
    sizes = np.bincount(cells)

    def near(left, right) -> np.ndarray:
        found = sum(np.bitwise_count(m[left] ^ m[right]).astype(np.int16) for m in marks)
        return found <= limit

    found_a, found_b = [], []
    # Small cells: all rows against the row one place further, two places further, ...
    live = np.flatnonzero(sizes[cells] <= small)
    step = 1
    while len(live):
        live = live[live + step < len(cells)]
        live = live[cells[live] == cells[live + step]]
        hits = live[near(live, live + step)]
        found_a.append(hits)
        found_b.append(hits + step)
        step += 1
    for cell in np.flatnonzero(sizes > small):
        low, high = np.searchsorted(cells, [cell, cell + 1])
        mine = np.arange(low, high)
        second = mine[sides[low:high] == 1]
        first = mine[sides[low:high] == 0]
        if not len(second):  # one block against itself
            second = first
        label_a = label_b = np.zeros(0, np.int64)
        for start in range(0, len(first), 256):
            left = first[start : start + 256]
            x, y = np.nonzero(near(left[:, None], second[None, :]))
            x, y = left[x] - low, second[y] - low
            if not (x != y).any():
                continue
            # Only a star per component goes on, never all links of a crowd.
            label = labels(
                high - low, np.concatenate([label_a, x]), np.concatenate([label_b, y])
            )
            label_a = np.flatnonzero(label != np.arange(high - low))
            label_b = label[label_a]
        found_a.append(label_a + low)
        found_b.append(label_b + low)
    if found_a:
        nodes = rows.column("node").to_numpy()
        yield from smallest_links(nodes, np.concatenate(found_a), np.concatenate(found_b))


def link_nodes(nodes: DataFrame, lanes: list[str], radius: int, limit: int) -> DataFrame:
    """Links (a, b) that connect nodes as all their pairs would.

    ``nodes`` has node (a number) and a fingerprint per lane. A pair is found if it is within
    ``radius`` bits in some lane, whose search misses none, and linked if all lanes together
    differ in at most ``limit`` bits.
    """
    total, together = bit_statistics(nodes, lanes)
    searches = [
        F.struct(F.lit(number).alias("lane"), F.lit(mask).cast("bigint").alias("mask"))
        for number in range(len(lanes))
        for mask in choose_plan(total, together[number], radius).masks()
    ]
    own = F.get(F.array(*lanes), F.col("s.lane"))
    members = nodes.select("node", *lanes, F.explode(F.array(*searches)).alias("s")).select(
        F.struct("s.lane", "s.mask", F.col("s.mask").bitwiseAND(own).alias("value")).alias("bucket"),
        "node",
        *lanes,
    )
    cells = block_pairs(members, "bucket", "node")

    def work(number: np.ndarray, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        return link_cells(number, rows, lanes, limit)

    return map_cells(cells, ["side", "node", *lanes], work, "a bigint, b bigint")


def groups(marks: DataFrame, radius: int, limit: int) -> DataFrame:
    """(fp0, ..., component_first): the smallest ``rank`` of each distinct fingerprint and
    everything it is linked to, directly or not. ``marks`` has fp0, ... and rank."""
    lanes = [c for c in marks.columns if c != "rank"]
    own = stage(
        marks.groupBy(*lanes)
        .agg(F.min("rank").alias("first"))
        .withColumn("node", F.monotonically_increasing_id()),
        "fingerprints",
    )
    linked = components(link_nodes(own.select("node", *lanes), lanes, radius, limit))
    named = stage(own.join(linked, "node", "left"), "named-fingerprints")
    lowest = (
        named.where(F.col("component").isNotNull())
        .groupBy("component")
        .agg(F.min("first").alias("lowest"))
    )
    joined = named.join(lowest, "component").select(*lanes, F.col("lowest").alias("component_first"))
    alone = named.where(F.col("component").isNull()).select(
        *lanes, F.col("first").alias("component_first")
    )
    return stage(joined.union(alone), "components")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    Fingerprints link at ``distance`` or fewer differing bits, all texts without words
    (NULL included) having the fingerprint 0. ``component_id`` is the smallest id reachable
    over links, itself included; it is NULL only if all ids reached are. Rows repeated
    under one id are rows of their own; an empty table gives no rows; other columns are
    not read. Equal fingerprints are one node, so copies make no pairs; among different
    ones no link is lost.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = stage(with_fingerprints(texts, shingle), "marks")
    rank = F.struct(F.col("id").isNull().alias("none"), "id").alias("rank")
    table = groups(marks.select("fp0", rank), distance, distance)
    return marks.join(table, "fp0").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp0")), 16, "0").alias("fingerprint"),
        F.col("component_first.id").alias("component_id"),
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    bands: int = 14,
    rows: int = 4,
    distance: int = DISTANCE,
) -> DataFrame:
    """The rows of ``docs`` that stay: exactly one per group of near copies, that with the
    smallest id (NULL last), all columns unchanged.

    Near copies share ``similarity`` or more of their distinct runs of ``shingle`` words
    (Jaccard), directly or over others. Texts are grouped by SimHash: fingerprints of their
    sets of runs that differ in ``distance`` or fewer bits, directly or over others, which the
    search of ``near_duplicates`` finds without a miss. Inside a group the sets are compared,
    so no text under the threshold is linked. Similar sets can differ in more bits (about ten
    of 64 at 0.8): for pairs of different groups, texts are also compared that agree in one of
    ``bands`` bands of ``rows`` MinHashes, which a direct pair at 0.8 misses with probability
    0.0006. Texts without words are copies of each other; repeated rows are reduced to one.
    """
    table = keyed(docs)
    texts = table.select(
        F.col(f"row.{id_col}").alias("id"), "row_key", F.col(f"row.{text_col}").alias("text")
    )
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row_key").alias("rank")
    marks = with_bands(texts, shingle, bands, rows, set_fingerprint)
    nodes = stage(  # texts of equal sets are one node
        marks.select("digest", "fp0", "bands", rank)
        .groupBy("digest")
        .agg(
            F.min("rank").alias("first"),
            F.any_value("fp0").alias("fp0"),
            F.any_value("bands").alias("bands"),
        )
        .select("first", "fp0", "bands", F.monotonically_increasing_id().alias("node")),
        "shingled",
    )
    near = groups(nodes.select("fp0", F.col("node").alias("rank")), distance, distance)
    grouped = nodes.join(near, "fp0").select("node", F.col("component_first").alias("near"), "bands")
    cells = stage(cells_of(grouped), "cells")
    met = nodes.join(cells.select("node").distinct(), "node", "left_semi")
    sets = with_sets(
        texts.join(met.select("node", F.col("first.row_key").alias("row_key")), "row_key"), shingle
    )
    linked = components(link_sets(cells, sets, similarity))
    named = nodes.select("node", "first").join(linked, "node", "left")
    kept = named.groupBy(F.coalesce("component", "node")).agg(F.min("first").alias("first"))
    return rows_in(table, stage(kept.select("first.row_key"), "kept"))
