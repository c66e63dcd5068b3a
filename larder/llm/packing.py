"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.encode import encoded

WINDOW = 2048
GROUP_TOKENS = 1 << 20
SLACK = 0.002

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, ids binary"
)


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Items dealt to ``windows`` near-equal windows by multiway differencing.

    Every item starts as a partial partition: one window holds it, the others are empty.
    The two partial partitions with the largest imbalance (fullest less emptiest window)
    are merged again and again, the fullest window of one onto the emptiest of the other,
    so that their imbalances cancel. Windows are kept in ascending order of fill, without
    the empty ones. Returns the item numbers of each window, empty windows left out.
    """
    # A slot is (fill, tie, items); items form a binary tree of pairs, flattened at the end.
    heap = [(-size, i, [(size, i, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        # The fullest windows of ``b`` meet the emptiest of ``a``, of which the first are
        # the empty ones that are not listed.
        shared = max(0, len(a) + len(b) - windows)
        met = []
        for x, y in zip(a[:shared], reversed(b[:shared])):
            tie += 1
            met.append((x[0] + y[0], tie, (x[2], y[2])))
        a = a[shared:]
        for slot in (*met, *b[shared:]):
            insort(a, slot)
        tie += 1
        empty = len(a) < windows
        heapq.heappush(heap, ((0 if empty else a[0][0]) - a[-1][0], tie, a))
    if not heap:
        return []
    out = []
    for _, _, tree in heap[0][2]:
        items, pending = [], [tree]
        while pending:
            node = pending.pop()
            if isinstance(node, tuple):
                pending.extend(node)
            else:
                items.append(node)
        out.append(sorted(items))
    return out


def pack(
    lengths: list[int], window: int = WINDOW, slack: float = SLACK
) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) that hold every token of every item once.

    Whole windows are cut off the front of long items. What is left is dealt to windows by
    ``difference``, at first as few as could hold it; the count rises by one as long as a
    window is over capacity and the padding stays within ``slack``. From windows that are
    still too full the end of the last item is cut and put where there is room: near-equal
    windows leave little to cut.
    """
    sequences: list[list[tuple[int, int, int]]] = []
    tails = []
    for item, length in enumerate(lengths):
        whole = length // window
        sequences += [[(item, k * window, window)] for k in range(whole)]
        if length % window:
            tails.append((item, whole * window, length % window))
    total = sum(t[2] for t in tails)
    count = -(-total // window)
    most = int(-(-total * (1 + slack) // window))
    while True:
        dealt = difference([t[2] for t in tails], count) if tails else []
        fullest = max((sum(tails[i][2] for i in d) for d in dealt), default=0)
        if fullest <= window or count >= most:
            break
        count += 1
    rest = []
    open_windows: list[list[tuple[int, int, int]]] = []
    for chosen in dealt:
        pieces = [tails[i] for i in chosen]
        over = sum(p[2] for p in pieces) - window
        while over > 0:
            item, start, length = pieces.pop()
            cut = min(over, length)
            if cut < length:
                pieces.append((item, start, length - cut))
            rest.append((item, start + length - cut, cut))
            over -= cut
        open_windows.append(pieces)
    open_windows += [[] for _ in range(count - len(open_windows))]
    for pieces in open_windows:
        room = window - sum(p[2] for p in pieces)
        while room and rest:
            item, start, length = rest.pop()
            take = min(room, length)
            pieces.append((item, start, take))
            if take < length:
                rest.append((item, start + take, length - take))
            room -= take
        if pieces:
            sequences.append(pieces)
    return sequences


def _emit(ids: list, raws: list[bytes], task: int, first: int, with_ids: bool):
    """A record batch with the pieces of one group, and the number of its sequences."""
    lengths = [len(r) // 2 for r in raws]
    sequences = pack(lengths)
    rows: list[tuple] = []
    for number, pieces in enumerate(sequences):
        offset = 0
        for item, start, length in pieces:
            part = np.frombuffer(raws[item], "<u2", length, 2 * start).astype("<u4").tobytes()
            rows.append(
                (
                    ids[item],
                    start,
                    length,
                    zlib.crc32(part),
                    lengths[item],
                    (task << 32) + first + number,
                    offset,
                    part if with_ids else None,
                )
            )
            offset += length
    columns = list(zip(*rows))
    types = [pa.int64()] * 7 + [pa.binary()]
    names = [p.split()[0] for p in PIECES.split(", ")]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=names
    )
    return batch, len(sequences)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece of a document in a sequence of at most 2048 tokens.

    A document is the ids of its text and ``end_id``; NULL and empty texts are that id
    alone. Documents are packed in groups of about ``group_tokens`` as a task reads them,
    so nothing is shuffled, a task holds one group, and a task that is run again packs the
    same. Only the last window of a group is padded, by less than one window, beyond the
    slack of ``pack``. Sequence ids hold the task in the high and a running number in the
    low 32 bits. Rows repeated under one id and NULL ids are documents of their own; other
    columns are not read; an empty table gives no rows. ``ids`` are unsigned 32-bit
    little-endian, or NULL without ``with_ids``.
    """
    end = np.array([end_id], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        ids: list = []
        raws: list[bytes] = []
        held = first = 0
        for batch, texts in encoded(batches, tokenizer):
            for number, raw in zip(batch.column("doc_id").to_pylist(), texts):
                ids.append(number)
                raws.append(raw + end)
                held += len(raw) // 2 + 1
                if held >= group_tokens:
                    out, made = _emit(ids, raws, task, first, with_ids)
                    yield out
                    first, held, ids, raws = first + made, 0, [], []
        if ids:
            yield _emit(ids, raws, task, first, with_ids)[0]

    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")
    )
    pieces = narrow.mapInArrow(run, PIECES)
    return pieces if with_ids else pieces.drop("ids")
