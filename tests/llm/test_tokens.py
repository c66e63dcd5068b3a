"""Encoding, packing, token files and token counts."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm import packing, tokencounts, tokenfiles
from larder.llm.encode import Encoder
from larder.llm.files import open_folder
from larder.llm.queries import vocabulary
from larder.session import fresh_path

LIBRARY = Tokenizer.from_file(vocabulary())
ENCODER = Encoder(vocabulary(), limit=50)


def library_ids(text, plain=False):
    LIBRARY.encode_special_tokens = plain
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("aAßÀ é'st12²!<|>\t\n\xa0\x1c\x85", max_size=60))
def test_ids_equal_the_library(text):
    assert np.frombuffer(ENCODER.encode(text), "<u2").tolist() == library_ids(text)


def test_ids_of_whole_documents(texts):
    one = Encoder(vocabulary())
    for text in texts.values():
        assert np.frombuffer(one.encode(text), "<u2").tolist() == library_ids(text)


def test_special_strings():
    text = "a <|endoftext|> b"
    assert 49407 in np.frombuffer(Encoder(vocabulary()).encode(text), "<u2")
    plain = np.frombuffer(Encoder(vocabulary(), plain=True).encode(text), "<u2")
    assert 49407 not in plain and plain.tolist() == library_ids(text, plain=True)


# -- packing -------------------------------------------------------------------


def test_differencing_by_hand():
    assert packing.difference([8, 7, 6, 5, 4], 2) == [[0, 2], [1, 3, 4]]  # 14 and 16
    assert packing.difference([], 3) == []
    assert sorted(packing.difference([5, 5, 5], 3)) == [[0], [1], [2]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=60), st.integers(1, 12))
def test_differencing_deals_every_item_once(sizes, windows):
    dealt = packing.difference(sizes, windows)
    assert len(dealt) <= windows
    assert sorted(i for d in dealt for i in d) == list(range(len(sizes)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=80), st.sampled_from([1, 7, 64, 2048]))
def test_pack_holds_every_token_once(lengths, window):
    sequences = packing.pack(lengths, window)
    seen = defaultdict(list)
    for pieces in sequences:
        assert 0 < sum(p[2] for p in pieces) <= window
        for item, start, length in pieces:
            assert length > 0
            seen[item].append((start, length))
    for item, length in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[item]):
            assert start == at
            at += size
        assert at == length
    total = sum(lengths)
    assert len(sequences) <= -(-total // window) + 1 + total * packing.SLACK / window


def check_pieces(rows, docs, end):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for number, text in docs.items():
        ids, at = library_ids(text) + [end], 0
        for r in sorted(by_doc[number], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == crc(ids[at : at + r.length])
            if "ids" in r.asDict():
                assert np.frombuffer(r.ids, "<u4").tolist() == ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW


def test_packed_documents(documents, texts):
    rows = packing.pack_documents(documents, vocabulary(), 1).collect()
    check_pieces(rows, texts, 1)
    used = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) * packing.WINDOW - used < 0.02 * used + 2048
    small = packing.pack_documents(documents, vocabulary(), 1, group_tokens=5000).collect()
    check_pieces(small, texts, 1)


def test_packing_odd_rows(odd, empty):
    rows = packing.pack_documents(odd.dropDuplicates(), vocabulary(), 1, with_ids=False).collect()
    check_pieces(rows, {r.doc_id: r.text for r in odd.collect()}, 1)
    twice = packing.pack_documents(odd, vocabulary(), 1).collect()
    assert sum(r.length for r in twice) > sum(r.length for r in rows)
    assert packing.pack_documents(empty, vocabulary(), 1).count() == 0


# -- token files -----------------------------------------------------------------


def check_files(spark, docs, rows, length):
    folder = fresh_path(spark, "test-sequences")
    manifest = tokenfiles.write_sequences(docs, folder, vocabulary(), 2, length=length)
    got = tokenfiles.document_digests(spark, folder, manifest).collect()
    at = 0
    for r, (number, text) in zip(sorted(got, key=lambda r: r.start), rows, strict=True):
        ids = library_ids(text) + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (number, at, len(ids), crc(ids))
        at += len(ids)
    return folder, manifest


@pytest.mark.parametrize("length", [2048, 16])
def test_token_files_round_trip(spark, documents, texts, length):
    folder, manifest = check_files(spark, documents.repartition(5), sorted(texts.items()), length)
    # Any sequence by its place, without reading what is before it.
    files = [r.file for r in manifest.orderBy("task").collect()]
    system, path = open_folder(folder)
    whole = [i for n, t in sorted(texts.items()) for i in library_ids(t) + [2]]
    ids, mask = tokenfiles.sequence(system, f"{path}/{files[0]}", 3)
    assert ids.to_pylist() == whole[3 * length : 4 * length] and all(mask.to_pylist())


def test_every_sequence_by_its_place(spark, tmp_path):
    """Documents of very different length, in several files; each sequence of each is read."""
    import pyarrow.fs

    length = 32
    sizes = [50, 800, 25_000, 3, 1, 2_047]
    docs = spark.createDataFrame(
        [(i, "a " * sizes[i % len(sizes)]) for i in range(36)], "doc_id bigint, text string"
    ).repartition(4)
    folder = fresh_path(spark, "test-places")
    manifest = tokenfiles.write_sequences(docs, folder, vocabulary(), 2, length=length)
    system, path = open_folder(folder)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    whole = np.array([i for _, t in rows for i in library_ids(t) + [2]])
    at = 0
    for entry in manifest.orderBy("task").collect():
        file = f"{path}/{entry.file}"
        mine = whole[at : at + entry.n_tokens]
        count = -(-entry.n_tokens // length)
        for number in range(count):
            ids, mask = tokenfiles.sequence(system, file, number)
            want = mine[number * length : (number + 1) * length]
            assert ids.to_numpy()[: len(want)].tolist() == want.tolist(), (entry.file, number)
            assert mask.to_pylist() == [True] * len(want) + [False] * (length - len(want))
        for beyond in (count, count + 1000, -1):
            with pytest.raises(IndexError):
                tokenfiles.sequence(system, file, beyond)
        at += entry.n_tokens
    assert at == len(whole)
    # From this machine's own store a sequence is a view of the mapped file.
    if isinstance(system, pyarrow.fs.LocalFileSystem):
        before = pa.total_allocated_bytes()
        views = [tokenfiles.sequence(system, file, n)[0] for n in range(min(count, 50))]
        assert pa.total_allocated_bytes() - before < 1024 and len(views)


def test_token_files_of_odd_rows(spark, odd, empty):
    docs = odd.dropDuplicates()
    rows = sorted(
        ((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0)
    )
    check_files(spark, docs, rows, 2048)
    check_files(spark, empty, [], 2048)


# -- token counts ----------------------------------------------------------------


def flat(spark, arrays, kind="<u2"):
    folder = fresh_path(spark, "test-tokens")
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    for n, ids in enumerate(arrays):
        with system.open_output_stream(f"{path}/part-{n}.bin") as sink:
            sink.write(np.array(ids, kind).tobytes())
    return folder


@pytest.mark.parametrize("block", [2, 6, 14, 4096])
def test_counts_are_stitched_across_blocks(spark, block):
    rng = np.random.default_rng(block)
    arrays = [rng.choice([7, 8, 9], size=s, p=[0.1, 0.5, 0.4]).tolist() for s in (50, 1, 200, 0)]
    arrays += [[7, 7, 7], [8] * 40, [8] * 40 + [7]]
    rows = tokencounts.count_tokens(spark, flat(spark, arrays), 7, 2, block).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.file, r.ordinal)):
        got[r.file].append((r.ordinal, r.start, r.n_tokens, r.closed))
    for n, ids in enumerate(arrays):
        expected, start = [], 0
        for i, token in enumerate([*ids, None]):
            if token == 7 or (token is None and i > start):
                expected.append((len(expected), start, i - start, token == 7))
                start = i + 1
        assert got.get(f"part-{n}.bin", []) == expected


def test_counts_of_wide_ids(spark):
    folder = flat(spark, [[70_000, 1, 2, 70_000]], "<u4")
    rows = tokencounts.count_tokens(spark, folder, 70_000, 4, 8).collect()
    assert sorted((r.start, r.n_tokens) for r in rows) == [(0, 0), (1, 2)]


def test_token_counts_of_documents(spark, documents, texts, odd, empty):
    folder = fresh_path(spark, "test-counts")
    rows = tokencounts.token_counts(documents, folder, vocabulary(), 49407, block_bytes=1000).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {n: len(library_ids(t)) for n, t in texts.items()}
    rows = tokencounts.token_counts(odd, fresh_path(spark, "c"), vocabulary(), 49407).collect()
    expected = [(r.doc_id, len(library_ids(r.text, plain=True))) for r in odd.collect()]
    key = lambda x: (x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=key) == sorted(expected, key=key)
    assert tokencounts.token_counts(empty, fresh_path(spark, "e"), vocabulary(), 49407).count() == 0
