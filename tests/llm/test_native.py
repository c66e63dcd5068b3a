"""Exact dedup, mixing and licence scan."""

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from check_queries import compare

from larder.llm import exact, licenses, mixing
from larder.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, DATA)
    cursor = duck.execute(ORACLE_SQL[name])
    expected = ([d[0] for d in cursor.description], cursor.fetchall())
    assert compare((df.columns, [tuple(r) for r in df.collect()]), expected) == "ok"


def lower_ascii(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_dedup_of_odd_rows(odd):
    rows = exact.exact_dedup(odd).collect()
    assert len(rows) == 11
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert {(r.keep_id, r.group_size, r.kept) for r in by_id[1]} == {(9, 4, False)}
    assert {(r.keep_id, r.kept) for r in by_id[2]} == {(9, False)}
    assert by_id[9][0].kept
    assert (by_id[3][0].keep_id, by_id[4][0].keep_id) == (4, 4)
    assert (by_id[None][0].keep_id, by_id[None][0].kept) == (6, False)
    long = hashlib.sha256(("word " * 60_000).encode()).hexdigest()
    assert by_id[8][0].text_sha256 == long


def test_exact_dedup_can_keep_the_smallest(odd):
    rows = {r.doc_id: r for r in exact.exact_dedup(odd, keep="smallest").collect()}
    assert rows[1].kept and rows[9].keep_id == 1 and rows[4].keep_id == 3


def test_merging_more_rounds_gives_the_same(odd):
    digests = odd.select("doc_id", *exact.digest_columns(odd.text)).withColumnRenamed("doc_id", "rank")
    def merged(runs, fan_in):
        return {(bytes(r.sha), r.keep, r.group_size) for r in exact.merge_runs(digests, runs=runs, fan_in=fan_in).collect()}
    assert merged(256, 16) == merged(64, 2) == merged(1 << 20, 32)


@pytest.mark.parametrize("frame", ["odd", "odd_file"])
def test_one_row_per_text_stays(request, frame):
    docs = request.getfixturevalue(frame)
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert Counter(r.doc_id for r in rows) == Counter([9, 4, 5, 6, 7, 8])
    assert len({lower_ascii(r.text) for r in rows}) == len(rows)


def test_empty_tables(empty):
    assert exact.exact_dedup(empty).count() == 0
    assert exact.drop_exact_copies(empty).count() == 0
    assert mixing.mixed_sizes(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert licenses.scan(empty).count() == 0


# -- mixing --------------------------------------------------------------------


def water_filling(sizes):
    """Targets by repeated sharing, straight from the rule."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        whole = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / whole for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10},
        {"a": 1000, "b": 1, "c": 2, None: 5},
        {"a": 0, "b": 7, "": 900},
        {"x": 3},
        {"x": 0, "y": 0},
        {chr(65 + i): (i * 37) % 11 for i in range(20)},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(water_filling(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_splitting_tree_keeps_quotas(spark):
    quota = [300, 0, 50, 1, 700, 2000, 12]
    frame = spark.createDataFrame(list(enumerate(quota)), "source_no int, quota bigint")
    for shards in (1, 2, 13):
        rows = mixing.split_quotas(frame, shards, "s").collect()
        per_source, per_shard = Counter(), Counter()
        for r in rows:
            assert r.quota >= 0
            per_source[r.source_no] += r.quota
            per_shard[r.shard] += r.quota
        assert [per_source[i] for i in range(7)] == quota
        assert len(per_shard) == shards and max(per_shard.values()) - min(per_shard.values()) <= 4


def test_draws_are_hypergeometric(spark):
    frame = spark.createDataFrame([(0, 30), (1, 70)], "source_no int, quota bigint")
    cells = mixing.split_quotas(frame, 2, "s0")
    for i in range(1, 120):
        cells = cells.union(mixing.split_quotas(frame, 2, f"s{i}"))
    drawn = [r.quota for r in cells.where("source_no = 0 AND shard = 0").collect()]
    assert abs(np.mean(drawn) - 15) < 4 * (5.3 / 120) ** 0.5
    assert 3 < np.var(drawn) < 9


def test_blocks_are_disjoint(spark):
    frame = spark.createDataFrame([(0, 25), (1, 4)], "source_no int, quota bigint")
    rows = mixing.block_shards(mixing.split_quotas(frame, 5, "s")).collect()
    assert sorted((r.source_no, r.block) for r in rows) == sorted(
        [(0, b) for b in range(25)] + [(1, b) for b in range(4)]
    )


def test_mix_agrees_with_its_plan(spark, documents):
    small = mixing.Settings(block_words=500, shard_words=4000)
    sizes = mixing.mixed_sizes(documents, settings=small).collect()
    again = mixing.mixed_sizes(documents.repartition(7), settings=small).collect()
    key = lambda r: r.doc_id
    assert sorted(sizes, key=key) == sorted(again, key=key)
    mixed = mixing.mix(documents, settings=small)
    assert mixed.columns == documents.columns
    copies = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert {r.doc_id: r.taken // r.size for r in sizes if r.taken} == dict(copies)
    largest = max(r.size for r in sizes)
    for total, target in {(r.source_size, r.target) for r in sizes}:
        own = [r for r in sizes if (r.source_size, r.target) == (total, target)]
        assert sum(r.size for r in own) == total
        assert abs(sum(r.taken for r in own) - target) <= largest / 2
        assert all(r.taken <= 3 * r.size for r in own)


@pytest.mark.parametrize("frame", ["odd", "odd_file"])
def test_mix_of_odd_rows(request, frame):
    docs = request.getfixturevalue(frame)
    rows = mixing.mixed_sizes(docs).collect()
    assert len(rows) == 11
    assert all(r.taken == 0 for r in rows if r.size == 0)
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == sum(r.taken // r.size for r in rows if r.size)


# -- licences --------------------------------------------------------------------


def test_bands_promise_what_they_say():
    for shingles in range(1, 400):
        size = licenses.size_class(shingles)
        window = licenses.window(size)
        least = 0.8 * shingles / (window + 0.2 * shingles)
        assert (1 - least) ** licenses.BANDS < 1e-3


def test_licences_are_found_anywhere(spark):
    filler = [f"w{i}" for i in range(400)]
    rows, expected = [], set()
    for n, (name, text) in enumerate(licenses.TEMPLATES.items()):
        for at in (0, 3, 57, 399):
            words = filler[:at] + [text.upper()] + filler[at:]
            rows.append((n * 1000 + at, " ".join(words)))
            expected.add((n * 1000 + at, name))
    changed = licenses.TEMPLATES["MIT-permission"].split()
    changed[20] = "something"  # five of its shingles go
    rows += [(1, " ".join(filler[:9] + changed)), (2, None), (2, ""), (4, "MIT")]
    rows.append((5, "under the License the Apache Version"))
    found = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = {(r.doc_id, r.license) for r in found}
    assert expected <= got and (1, "MIT-permission") in got
    assert not {d for d, _ in got} & {2, 4, 5}
    place = {(r.doc_id, r.license): r.first_word for r in found}
    assert place[(57, "MIT")] == 57
