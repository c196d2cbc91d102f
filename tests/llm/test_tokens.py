"""Encoding, decoding, packing and files against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keelson.functions.storage import work_folder
from keelson.llm import bpe, packing, planes, tokens

PATH = tokens.default_path()
LIBRARY = Tokenizer.from_file(PATH)


def want(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.text("aAbB'sS tT<|endoftext|>éßİΣ \n.,!1２"), st.sampled_from(["<|endoftext|>", "x<|startoftext|>y", "it's we'LL"]))))
def test_ids_equal_the_library(texts):
    for kind in ("tree", "library"):
        ids, counts = tokens.encoder(PATH, kind)(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [want(t) for t in texts] or not texts


def test_forgetting_words_changes_nothing():
    small = tokens.TextEncoder(PATH, bpe.tree_parts(PATH), remembered=3)
    texts = [f"some words here number {i} some more" for i in range(30)]
    for _ in range(2):
        for t in texts:
            assert small(pa.array([t]))[0].tolist() == want(t)


def test_merges_of_long_parts_take_the_leftmost_lowest_pair():
    trees = bpe.PairTrees(PATH)
    for part in ("aaaaaaa", "thethethethe", "x" * 1000, "a"):
        ids, counts = trees([part])
        assert ids.tolist() == want(part) and counts.tolist() == [len(ids)]


def test_round_trip_of_odd_documents(odd_docs, no_docs):
    rows = bpe.round_trip_query(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {}
    for r in odd_docs.collect():
        ids = want(r["text"])
        by_id.setdefault(r["doc_id"], []).append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in by_id.items()}
    assert bpe.round_trip_query(no_docs).count() == 0
    extra = bpe.decode(bpe.encode(odd_docs))
    assert extra.count() == len(rows) and "ids" in extra.columns and "row_key" in extra.columns


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_plan_is_best_fit_decreasing(case):
    capacity, lengths = case
    counts = {n: lengths.count(n) for n in set(lengths)}
    fill, placed = {}, {n: set() for n in counts}
    for length, rank, pieces, first, each, offset in packing.plan(counts, capacity).tolist():
        for k in range(pieces):
            assert rank + k not in placed[length]
            placed[length].add(rank + k)
            fill.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert {n: len(v) for n, v in placed.items()} == counts
    rooms = []
    for parts in fill.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        rooms.append(capacity - end)
    assert sorted(rooms) == plain_best_fit(lengths, capacity)


def test_packing_of_odd_documents(odd_docs, no_docs):
    rows = packing.pack(odd_docs).collect()
    texts = sorted((r["doc_id"] is None, r["doc_id"] or 0, want(r["text"]) + [0]) for r in odd_docs.collect())
    assert sum(r["length"] for r in rows) == sum(len(t[2]) for t in texts)
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] and r["start"] == 2048 * r["piece"] for r in rows)
    assert sorted(r["length"] for r in rows if r["piece"] == 0) == sorted(min(2048, len(t[2])) for t in texts)
    fill = {}
    for r in rows:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    rooms = []
    for parts in fill.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        rooms.append(2048 - end)
    assert sorted(rooms) == plain_best_fit([r["length"] for r in rows], 2048)
    assert packing.pack(no_docs, ids=False).count() == 0
    whole = packing.sequences(packing.pack(odd_docs)).collect()
    assert sorted(s["n_tokens"] for s in whole) == sorted(2048 - r for r in rooms) and all(len(s["ids"]) == 4 * s["n_tokens"] for s in whole)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_planes_round_trip(ids):
    block = np.array(ids, np.uint32)
    parts = planes.to_planes(block)
    assert len(parts) == (int(block.max()).bit_length() if len(block) else 0)
    assert planes.from_planes(b"".join(parts), np.array([len(p) for p in parts]), len(block)).tolist() == ids


def test_files_of_odd_documents(spark, odd_docs, no_docs):
    for block in (7, 4096, 1 << 20):  # documents over many blocks, and many documents in one
        folder = work_folder(spark, "planes-test")
        planes.write(odd_docs, folder, block=block)
        rows = planes.read(spark, folder).orderBy("start").collect()
        assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
        assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i or 0))
        got = sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows)
        assert got == sorted((str(r["doc_id"]), want(r["text"]) + [1]) for r in odd_docs.collect())
        index = spark.read.parquet(f"{folder}/index").collect()
        assert sum(r["n_ids"] for r in index) == sum(r["n_tokens"] for r in rows)
    folder = work_folder(spark, "planes-test")
    planes.write(no_docs, folder)
    assert planes.read(spark, folder).count() == 0
