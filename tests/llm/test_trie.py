"""The conversation trie against a plain trie in memory."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from larder.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, owner string, depth bigint, `a.b` int"


def plain_trie(rows):
    """Rows of (conv, turn, role, text) to rows of the trie."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found[conv].append((turn is not None, turn or 0, mark, (role, text)))
    own = {c: [v[3] for v in sorted(turns)] for c, turns in found.items()}
    members = defaultdict(list)
    whole = {}
    for c in own:
        head = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        whole[c] = tuple(own.get(base, [])[:head] + own[c][head:])
        for depth in range(len(whole[c]) + 1):
            members[whole[c][:depth]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, convs in members.items():
        for depth in range(len(p) + 1):
            leaves[p[:depth]] += children[p] == 0
            saved[p[:depth]] += (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (
            len(p),
            min(convs),
            min(members[p[:-1]]) if p else -(10**9),
            len(convs),
            children[p],
            leaves[p],
            saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if whole[c] == p).encode()).hexdigest(),
        )
        for p, convs in members.items()
    )


def collected(frame):
    return sorted(
        (
            r.depth,
            r.conv_id,
            -(10**9) if r.parent_conv_id is None else r.parent_conv_id,
            r.n_convs,
            r.n_children,
            r.n_leaves,
            r.saved_tokens,
            r.ends_sha256,
        )
        for r in frame.collect()
    )


def shared_talks():
    """Families that share beginnings, one long talk, many equal ones, repeated and NULL turns."""
    rng = np.random.default_rng(3)
    rows = []
    for c in range(-7, 60):
        for turn in range(int(rng.integers(1, 9))):
            rows.append((c, turn, ["user", None][turn % 2], f"t{rng.integers(0, 2)}é" if turn else "hello"))
    rows += [(200, t, "user", f"long {t}") for t in range(150)]
    rows += [(c, t, "user", "same") for c in range(300, 330) for t in (0, 1)]
    rows += [(400, None, "user", "first"), (400, 1, None, None), (400, 1, "user", "tie"), (400, 1, "user", "tie")]
    rows += [(401, 1, "", ""), (None, 0, "user", "nobody"), (403, 0, "user", "x" * 30_000)]
    return rows


@pytest.mark.parametrize("block", [6, 4096])
def test_equals_plain_trie(spark, block):
    rows = shared_talks()
    frame = spark.createDataFrame([(*r, "o", 1, 2) for r in rows], SCHEMA).repartition(5)
    assert collected(trie.conversation_trie(frame, block=block)) == plain_trie(rows)


def test_empty_table_has_no_root(spark):
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_supplied_conversations(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert collected(trie.conversation_trie(frame)) == plain_trie(rows)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_centroids_give_subtree_sums(shape):
    rng = np.random.default_rng(11)
    n = 400
    parent = np.array(
        [-1 if i == 0 or (shape == "forest" and i % 50 == 0) else
         {"chain": i - 1, "star": 0}.get(shape, int(rng.integers(max(0, i - 30), i))) for i in range(n)]
    )
    depth, size = np.zeros(n, int), np.ones(n, int)
    own = rng.integers(0, 9, (n, 2))
    want = own.copy()
    for i in range(n):
        depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
    for i in reversed(range(n)):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
            size[parent[i]] += size[i]
    order = rng.permutation(n)
    place = np.argsort(order)
    moved = np.where(parent[order] < 0, -1, place[parent[order]])
    assert (trie.roll_up(moved, depth[order], size[order], own[order]) == want[order]).all()
