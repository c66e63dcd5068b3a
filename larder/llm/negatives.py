"""Hard negatives by angular triangle filtering.

Each row stores its angles to a few reference directions. The angle between two rows lies
between the difference and the sum of their angles to any one of them, which bounds their
inner product. Bounds are tested for pairs of blocks in Spark and for strips of rows inside a
block; only what can reach a wanted window of scores is scored, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.buckets import map_cells
from larder.llm.rows import keyed
from larder.operators.ranks import running_totals
from larder.session import stage

SCALE = 256
REFERENCES = 16
SAMPLE = 1024
ROWS = 4096
ANCHORS = 1024
STRIP = 64
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # per cent of the positive's score
LARGEST = float(1 << 61)  # of a squared norm: scores then fit a long
EXACT = float(1 << 52)  # of a product of norms: sums of doubles are then exact
SLACK = 1e-9  # of a cosine, for rounding in angles
TOP = np.iinfo(np.int64).max


def prepared(
    vectors: DataFrame, id_col: str, vector_col: str, label_col: str, relabel: Callable[[Column, Column], Column]
) -> DataFrame:
    """(row_key, id, label, vector, norm2, width): the rows that take part, in whole numbers."""
    rows = keyed(vectors)
    vector = F.col(f"row.{vector_col}")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    # Beyond 2^61 a floor() would leave the range of a long; such rows fail the norm anyway.
    bounded = F.forall(vector, lambda x: F.abs(x.cast("double") * SCALE) < LARGEST)
    usable = F.coalesce(finite & bounded, F.lit(False)) & F.col(f"row.{label_col}").isNotNull()
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    key = F.col(f"row.{id_col}").cast("bigint")
    return (
        rows.where(usable)
        .select(
            "row_key",
            key.alias("id"),
            relabel(key, F.col(f"row.{label_col}")).cast("string").alias("label"),
            whole.alias("vector"),
            F.size(vector).alias("width"),
        )
        .withColumn("norm2", norm)
        .where(F.col("norm2") < LARGEST)
    )


def references(rows: DataFrame, count: int = REFERENCES, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Reference directions by vector length: rows far apart in a bounded sample.

    At most ``sample`` rows, chosen by a hash of their key, reach the driver. Any directions
    give right results; far ones cut more.
    """
    drawn = rows.where(F.col("norm2") > 0).orderBy(F.xxhash64("row_key")).limit(sample)
    found: dict[int, list[np.ndarray]] = {}
    for row in drawn.select("vector").collect():
        v = np.array(row.vector)
        found.setdefault(len(v), []).append(v / np.sqrt(v @ v))
    chosen = {}
    for width, units in found.items():
        units = np.stack(units)
        picks = [0]
        nearest = units @ units[0]
        while len(picks) < min(count, len(units)):
            picks.append(int(np.argmin(nearest)))
            nearest = np.maximum(nearest, units @ units[picks[-1]])
        chosen[width] = units[picks]
    return chosen


def with_angles(rows: DataFrame, directions: dict[int, np.ndarray], count: int = REFERENCES) -> DataFrame:
    """Add ``angles`` to the reference directions and ``near``, the number of the closest one.

    A vector of zeros has no angle: its scores are zero whatever its angles are, which the
    norm sees to. Lengths that the sample did not hold have no references and are not cut.
    """
    held = rows.sparkSession.sparkContext.broadcast(directions)  # a few of a bounded sample
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(widths)])
            angles = np.full((len(widths), count), np.pi / 2)
            for width in np.unique(widths):
                mine = np.flatnonzero(widths == width)
                known = held.value.get(int(width))
                if known is None or not width:
                    continue
                vectors = np.stack([flat[ends[i] : ends[i + 1]] for i in mine])
                norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
                cosines = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0) @ known.T
                angles[mine, : len(known)] = np.arccos(np.clip(cosines, -1, 1))
                angles[mine, len(known) :] = angles[mine, :1]
            listed = pa.ListArray.from_arrays(np.arange(len(widths) + 1, dtype=np.int32) * count, angles.ravel())
            near = angles.argmin(axis=1) if len(widths) else np.zeros(0, np.int64)
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, listed, pa.array(near.astype(np.int32))], names=[*names, "angles", "near"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, angles array<double>, near int")


def in_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Add ``block``: rows of like label and angle share one, ``size`` rows in each."""
    order = ["width", "label", "near", F.element_at("angles", F.col("near") + 1), "row_key"]
    ranked = running_totals(rows.withColumn("one", F.lit(1)), order, {"n": "one"})
    block = F.floor((F.col("n_through") - 1) / size)
    return ranked.withColumn("block", block).drop("one", "n_through", "n_total")


def block_facts(rows: DataFrame, prefix: str, count: int = REFERENCES) -> DataFrame:
    """One row per block: what bounds the scores of its rows."""
    angle = lambda i: F.element_at("angles", i + 1)
    facts = rows.groupBy("block").agg(
        F.min("width").alias("w0"),
        F.max("width").alias("w1"),
        F.min("label").alias("l0"),
        F.max("label").alias("l1"),
        F.sqrt(F.max("norm2")).alias("norm"),
        F.array(*(F.min(angle(i)) for i in range(count))).alias("a0"),
        F.array(*(F.max(angle(i)) for i in range(count))).alias("a1"),
    )
    return facts.select(*(F.col(c).alias(f"{prefix}_{c}") for c in facts.columns))


def score_bounds() -> tuple[Column, Column]:
    """Least and largest score that two blocks can have, by their angles and norms."""
    pi = F.lit(float(np.pi))
    low_angle = F.array_max(
        F.zip_with(
            F.zip_with("q_a0", "r_a1", lambda a, b: a - b),
            F.zip_with("r_a0", "q_a1", lambda a, b: a - b),
            lambda a, b: F.greatest(a, b, F.lit(0.0)),
        )
    )
    least = F.zip_with("q_a0", "r_a0", lambda a, b: a + b)
    most = F.zip_with("q_a1", "r_a1", lambda a, b: a + b)
    around = F.zip_with(least, most, lambda a, b: F.when(a >= pi, 2 * pi - a).otherwise(F.least(b, pi)))
    high_angle = F.array_min(around)
    scale = F.col("q_norm") * F.col("r_norm")
    upper = scale * (F.cos(low_angle) + SLACK)
    lower = scale * (F.cos(high_angle) - SLACK)
    # Norms vary inside a block: a positive bound holds for the longest, a negative one too.
    return F.least(lower, F.lit(0.0)) - 1, F.greatest(upper, F.lit(0.0)) + 1


class Block:
    """Rows of one side of a cell, in strips that bounds are kept for."""

    def __init__(self, rows: pa.RecordBatch, at: np.ndarray) -> None:
        take = rows.take(pa.array(at))
        self.at, self.count = at, len(at)
        self.key = take.column("row_no").to_numpy()
        self.id = take.column("id")
        self.label = take.column("label").to_numpy()
        self.vectors = take.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(self.count, -1)
        self.angles = take.column("angles").flatten().to_numpy().reshape(self.count, -1)
        self.norm = np.sqrt(take.column("norm2").to_numpy())

    def strips(self) -> tuple[list[slice], np.ndarray, np.ndarray, np.ndarray]:
        cuts = [slice(i, min(i + STRIP, self.count)) for i in range(0, self.count, STRIP)]
        return (
            cuts,
            np.stack([self.angles[c].min(axis=0) for c in cuts]),
            np.stack([self.angles[c].max(axis=0) for c in cuts]),
            np.array([self.norm[c].max() for c in cuts]),
        )


def bounds(queries: Block, low: np.ndarray, high: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) score of each query with each strip, safe against rounding."""
    least, largest = np.zeros((queries.count, len(low))), np.full((queries.count, len(low)), np.pi)
    for k in range(low.shape[1]):
        mine = queries.angles[:, k : k + 1]
        least = np.maximum(least, np.maximum(mine - high[:, k], low[:, k] - mine))
        around = np.where(mine + low[:, k] >= np.pi, 2 * np.pi - mine - low[:, k], np.minimum(mine + high[:, k], np.pi))
        largest = np.minimum(largest, around)
    scale = queries.norm[:, None] * norms
    lower = np.minimum(scale * (np.cos(largest) - SLACK), 0) - 1
    upper = np.maximum(scale * (np.cos(least) + SLACK), 0) + 1
    return lower, upper


def scores(queries: Block, who: np.ndarray, rows: Block, strip: slice) -> np.ndarray:
    """Inner products in whole numbers."""
    left, right = queries.vectors[who], rows.vectors[strip]
    if not left.shape[1]:
        return np.zeros((len(left), right.shape[0]), np.int64)
    if queries.norm[who].max() * rows.norm[strip].max() < EXACT:
        return (left @ right.T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def _ids(block: Block) -> np.ndarray:
    """Ids for breaking ties; a NULL id comes last."""
    return block.id.fill_null(TOP).to_numpy()


def _sides(cells: np.ndarray, rows: pa.RecordBatch) -> Iterator[tuple[Block, Block]]:
    side = rows.column("side").to_numpy()
    width = rows.column("width").to_numpy()
    edges = np.flatnonzero(np.diff(cells)) + 1
    for low, high in zip([0, *edges], [*edges, len(cells)]):
        at = np.arange(low, high)
        for w in np.unique(width[low:high]):
            queries = at[(side[low:high] == 0) & (width[low:high] == w)]
            others = at[(side[low:high] == 1) & (width[low:high] == w)]
            if len(queries) and len(others):
                yield Block(rows, queries), Block(rows, others)


PAIR = "anchor bigint, row_no bigint, id bigint, score bigint"


def find_positives(cells: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """(anchor, number, id, score): best rows of an anchor's label in each cell.

    Strips are visited by falling upper bound; one that cannot reach an anchor's ``limit``
    best so far is not scored for it.
    """

    def work(number: np.ndarray, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for queries, others in _sides(number, rows):
            cuts, low, high, norms = others.strips()
            _, upper = bounds(queries, low, high, norms)
            ids = _ids(others)
            best = [[] for _ in range(queries.count)]
            floor = np.full(queries.count, -np.inf)
            for s in np.argsort(-upper.max(axis=0), kind="stable"):
                strip = cuts[s]
                label = others.label[strip]
                who = np.flatnonzero((upper[:, s] >= floor) & np.isin(queries.label, label))
                if not len(who):
                    continue
                found = scores(queries, who, others, strip)
                fits = (queries.label[who][:, None] == label) & (queries.key[who][:, None] != others.key[strip])
                fits &= found >= floor[who][:, None]
                for i in np.flatnonzero(fits.any(axis=1)):
                    at = np.flatnonzero(fits[i])
                    held = best[who[i]]
                    held += zip((-found[i, at]).tolist(), ids[strip][at].tolist(), (at + strip.start).tolist())
                    held.sort()
                    del held[limit:]
                    if len(held) == limit:
                        floor[who[i]] = -held[-1][0]
            yield from _pairs(queries, others, best)

    return map_cells(cells, columns, work, PAIR)


def _pairs(queries: Block, others: Block, best: list[list]) -> Iterator[pa.RecordBatch]:
    anchor = np.repeat(queries.key, [len(b) for b in best])
    at = np.array([place for b in best for _, _, place in b], np.int64)
    score = np.array([-value for b in best for value, _, _ in b], np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(anchor), pa.array(others.key[at]), others.id.take(pa.array(at)), pa.array(score)],
        names=["anchor", "row_no", "id", "score"],
    )


def find_negatives(cells: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """(anchor, positive, id, score, number): best rows of other labels in each window.

    An anchor brings the windows of its positives; strips whose bounds miss all of an
    anchor's windows are not scored for it.
    """

    def work(number: np.ndarray, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for queries, others in _sides(number, rows):
            windows = rows.column("windows").take(pa.array(queries.at)).to_pylist()
            width = max(map(len, windows))
            least = np.full((queries.count, width), TOP)  # rises to the last score held
            most = np.full((queries.count, width), -TOP)
            for q, ws in enumerate(windows):
                least[q, : len(ws)] = [w["low"] for w in ws]
                most[q, : len(ws)] = [w["high"] for w in ws]
            cuts, low, high, norms = others.strips()
            lower, upper = bounds(queries, low, high, norms)
            ids = _ids(others)
            best = [[[] for _ in ws] for ws in windows]
            for s in np.argsort(-upper.max(axis=0), kind="stable"):
                strip = cuts[s]
                reached = (upper[:, s, None] >= least) & (lower[:, s, None] <= most)
                who = np.flatnonzero(reached.any(axis=1))
                if not len(who):
                    continue
                found = scores(queries, who, others, strip)
                other = queries.label[who][:, None] != others.label[strip]
                for j in range(width):
                    hits = other & (found >= least[who, j, None]) & (found <= most[who, j, None])
                    for i in np.flatnonzero(hits.any(axis=1)):
                        at = np.flatnonzero(hits[i])
                        held = best[who[i]][j]
                        held += zip((-found[i, at]).tolist(), ids[strip][at].tolist(), (at + strip.start).tolist())
                        held.sort()
                        del held[limit:]
                        if len(held) == limit:
                            least[who[i], j] = -held[-1][0]
            flat = [(k, w["row_no"], h) for k, ws, b in zip(queries.key.tolist(), windows, best) for w, h in zip(ws, b)]
            sizes = [len(h) for _, _, h in flat]
            places = np.array([p for _, _, h in flat for _, _, p in h], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([f[0] for f in flat], np.int64), sizes)),
                    pa.array(np.repeat(np.array([f[1] for f in flat], np.int64), sizes)),
                    pa.array(others.key[places]),
                    others.id.take(pa.array(places)),
                    pa.array(np.array([-v for _, _, h in flat for v, _, _ in h], np.int64)),
                ],
                names=["anchor", "positive", "row_no", "id", "score"],
            )

    return map_cells(cells, columns, work, "anchor bigint, positive bigint, row_no bigint, id bigint, score bigint")


def meet(anchors: DataFrame, rows: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Anchor blocks and row blocks brought together in a cell per pair of blocks."""
    cell = F.struct("q", "r").alias("cell")
    left = anchors.join(pairs, anchors["block"] == pairs["q"])
    right = rows.join(pairs, rows["block"] == pairs["r"])
    return left.select(cell, F.lit(0).alias("side"), *columns).union(
        right.select(cell, F.lit(1).alias("side"), *columns)
    )


def best_of(found: DataFrame, group: list[str], limit: int) -> DataFrame:
    """The first ``limit`` of each group by score, then id, then row; ``rank`` from 1."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row_no")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Callable[[Column], Column],
    relabel: Callable[[Column, Column], Column] = lambda id_, label: label,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block: int = ROWS,
    anchor_block: int = ANCHORS,
    count: int = REFERENCES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows for which ``is_anchor(id)`` holds. An anchor's positives are its
    ``positives`` best other rows of the same label; for each, the ``negatives`` best rows of
    other labels whose score is ``low`` to ``high`` per cent of the positive's are returned.
    Scores are inner products of the components' floors after multiplication by 256; higher
    comes first, then the smaller id, a NULL id last, then the row's place.

    Rows with a NULL label or vector, or a NULL or non-finite component, take no part; nor do
    vectors whose squared norm in whole numbers is 2^61 or more, so that no score leaves a
    long. Vectors of different length have no score with each other. Vectors of zeros and
    empty ones score 0. Rows repeated under one id are rows of their own, so an anchor given
    twice has its negatives twice, and a copy can be a positive. A NULL id is no anchor. Other
    columns are not read; an empty table gives no rows. Labels may be of any type with an
    order; they are compared as text.
    """
    rows = prepared(vectors, id_col, vector_col, label_col, relabel)
    rows = stage(rows, "rows")
    directions = references(rows, count)
    labels = stage(rows.select("label").distinct().withColumn("label_no", F.monotonically_increasing_id()), "labels")
    numbered = (
        with_angles(rows, directions, count)
        .join(labels, "label")
        .drop("label")
        .withColumnRenamed("label_no", "label")
    )
    numbered = stage(in_blocks(numbered, block).withColumn("row_no", F.monotonically_increasing_id()), "blocks")
    columns = ["row_no", "id", "label", "width", "vector", "angles", "norm2"]
    chosen = numbered.where(F.coalesce(is_anchor(F.col("id")), F.lit(False))).drop("block")
    anchors = stage(in_blocks(chosen, anchor_block), "anchors")
    grid = stage(
        block_facts(anchors, "q", count).join(
            # The query set against all rows, in blocks: a row per pair of blocks that share a length.
            block_facts(numbered, "r", count),
            (F.col("q_w0") <= F.col("r_w1")) & (F.col("r_w0") <= F.col("q_w1")),
        ),
        "grid",
    )
    same = (F.col("q_l0") <= F.col("r_l1")) & (F.col("r_l0") <= F.col("q_l1"))
    pairs = grid.where(same).select(F.col("q_block").alias("q"), F.col("r_block").alias("r"))
    plain = ["side", *columns]
    found = find_positives(meet(anchors, numbered, pairs, columns), plain, positives)
    best = stage(best_of(found, ["anchor"], positives).drop("rank"), "positives")

    # low * positive <= 100 * negative <= high * positive, in whole numbers; decimals do not overflow.
    wide = F.col("score").cast("decimal(20,0)")
    window = F.struct(
        F.ceil(wide * low / 100).cast("bigint").alias("low"),
        F.floor(wide * high / 100).cast("bigint").alias("high"),
        "row_no",
    )
    windows = best.groupBy("anchor").agg(F.collect_list(window).alias("windows"))  # at most ``positives``
    asked = stage(anchors.join(windows.withColumnRenamed("anchor", "row_no"), "row_no"), "asked")
    reach = asked.groupBy(F.col("block").alias("q")).agg(
        F.min(F.array_min(F.transform("windows", lambda w: w["low"]))).alias("least"),
        F.max(F.array_max(F.transform("windows", lambda w: w["high"]))).alias("most"),
    )
    lower, upper = score_bounds()
    one_label = (F.col("q_l0") == F.col("q_l1")) & (F.col("r_l0") == F.col("r_l1")) & (F.col("q_l0") == F.col("r_l0"))
    open_pairs = (
        grid.withColumnRenamed("q_block", "q")
        .join(reach, "q")
        .where(~one_label & (upper >= F.col("least")) & (lower <= F.col("most")))
        .select("q", F.col("r_block").alias("r"))
    )
    none = F.lit(None).cast(asked.schema["windows"].dataType).alias("windows")
    cells = meet(asked, numbered.withColumn("windows", none), open_pairs, [*columns, "windows"])
    mined = best_of(
        find_negatives(cells, [*plain, "windows"], negatives), ["anchor", "positive"], negatives
    )
    named = best.join(anchors.select(F.col("row_no").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return (
        mined.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .drop("row_no")
        .join(
            named.select(
                "anchor",
                F.col("row_no").alias("positive"),
                "anchor_id",
                F.col("id").alias("positive_id"),
                F.col("score").alias("positive_score"),
            ),
            ["anchor", "positive"],
        )
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
