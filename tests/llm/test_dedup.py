"""Exact, near and substring dedup against brute force."""

import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import exact_dedup, near_dedup, substring
from tests.llm.conftest import WORDS, prose


def words(text):
    return WORDS.findall(text or "")


def order(doc_id):
    return 2**63 - 1 if doc_id is None else doc_id


def brute_exact(rows):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault("".join(words(r["text"])), []).append((-len(r["text"] or ""), order(r["doc_id"]), i))
    return {norm: min(g) + (len(g),) for norm, g in groups.items()}


def test_exact_groups(odd_docs, no_docs):
    rows = odd_docs.collect()
    want = brute_exact(rows)
    for weak in ({}, {"bases": (3,), "prime": 5}, {"bases": (1,), "prime": 2, "chunk_bytes": 16}):  # fingerprints that collide
        got = exact_dedup.find_duplicates(odd_docs, sha256=True, **weak).collect()
        assert len(got) == len(rows) and sum(r["kept"] for r in got) == len(want)
        expect = sorted(
            (str(r["doc_id"]), str(None if (b := want["".join(words(r["text"]))])[1] == 2**63 - 1 else b[1]), b[3], hashlib.sha256("".join(words(r["text"])).encode()).hexdigest()) for r in rows
        )
        assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == expect
    assert exact_dedup.find_duplicates(no_docs).count() == 0 and exact_dedup.drop_duplicates(no_docs).count() == 0


def test_exact_rows_keep_their_columns(odd_docs):
    left = exact_dedup.drop_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    rows = left.collect()
    norms = ["".join(words(r["text"])) for r in rows]
    assert len(norms) == len(set(norms)) == len(brute_exact(odd_docs.collect()))


def test_chunk_hashes_compose():
    import pyarrow as pa

    text = bytes(range(256)) * 40
    whole = exact_dedup.chunk_hashes(pa.array([text]), np.array([0]), exact_dedup.BASES, exact_dedup.PRIME)
    cut = [text[i : i + 700] for i in range(0, len(text), 700)]
    after = np.array([len(text) - min(len(text), (i + 1) * 700) for i in range(len(cut))])
    parts = exact_dedup.chunk_hashes(pa.array(cut), after, exact_dedup.BASES, exact_dedup.PRIME)
    assert [int(p.sum() % exact_dedup.PRIME) for p in parts] == [int(w[0]) for w in whole]
    value = 0
    for b in text:
        value = (value * exact_dedup.BASES[0] + b + 1) % exact_dedup.PRIME
    assert value == int(whole[0][0])


def bag(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter({tuple(w): 1} if w else {})


def brute_classes(rows, threshold=0.8):
    bags, label = [bag(r["text"]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = bags[i], bags[j]
            if (not a and not b) or (a and b and sum((a & b).values()) >= threshold * sum((a | b).values())):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    best = {}
    for k, r in enumerate(rows):
        best[label[k]] = min(best.get(label[k], 2**63 - 1), order(r["doc_id"]))
    return [None if best[x] == 2**63 - 1 else best[x] for x in label], len(best)


def test_near_classes(odd_docs, no_docs):
    rows = odd_docs.collect()
    want, n = brute_classes(rows)
    got = near_dedup.find_classes(odd_docs).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in got) == sorted((str(r["doc_id"]), str(c)) for r, c in zip(rows, want))
    left = near_dedup.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == n
    assert near_dedup.find_classes(no_docs).count() == 0 and near_dedup.drop_near_duplicates(no_docs).count() == 0


def test_a_large_family_of_near_copies_is_one_class(spark):
    base = prose(9, 300).split()
    rows = [(i, " ".join(base[:k] + [f"n{i}"] + base[k + 1 :])) for i, k in enumerate(range(5, 295))] + [(1000 + i, prose(100 + i, 120)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.find_classes(docs).collect()
    assert {r["class_id"] for r in got if r["doc_id"] < 1000} == {0}
    assert all(r["class_id"] == r["doc_id"] for r in got if r["doc_id"] >= 1000)


def test_equal_rows_are_shingled_once(spark, monkeypatch):
    """Hundreds of rows with one id and text, and as many copies without an id, are one node each."""
    base = prose(11, 200).split()
    near = base[:60] + ["other"] + base[61:]
    rows = [(7, " ".join(base))] * 500 + [(None, "  ".join(base))] * 300 + [(9, " ".join(near)), (11, prose(12, 150)), (11, prose(12, 150))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, plain = [], near_dedup._bags
    monkeypatch.setattr(near_dedup, "_bags", lambda texts: seen.append(texts.count()) or plain(texts))
    got = near_dedup.find_classes(docs).collect()
    assert len(seen) == 1 and seen[0] <= 2  # the unit of the 800 copies and its near copy
    assert sorted((str(r["doc_id"]), r["class_id"]) for r in got) == sorted([("7", 7)] * 500 + [("None", 7)] * 300 + [("9", 7)] + [("11", 11)] * 2)
    assert near_dedup.drop_near_duplicates(docs).count() == 2


def test_links_along_a_chain_are_not_lost(spark):
    """A chain whose ends are unlike: every link counts, in whichever block it is found."""
    base = prose(10, 200).split()
    rows, text = [], list(base)
    for i in range(40):
        rows.append((i, " ".join(text)))
        text = list(text)
        for k in range(3):
            text[(i * 5 + k) % 200] = f"c{i}_{k}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute_classes([{"doc_id": i, "text": t} for i, t in rows])
    for block_cells in (near_dedup.BLOCK_CELLS, 700):  # buckets in one block, and in many
        got = {r["doc_id"]: r["class_id"] for r in near_dedup.find_classes(docs, bands=60, rows=3, block_cells=block_cells).collect()}
        assert got == dict(enumerate(want))


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    a = np.repeat(rng.integers(0, 2**63, 60).astype(np.uint64), rng.integers(1, 6, 60))
    b = np.concatenate([a[: len(a) * 3 // 4], rng.integers(0, 2**63, len(a) // 4).astype(np.uint64)])
    doc, cells = near_dedup.weighted_cells(np.concatenate([a, b]), np.array([len(a), len(b)]))
    x, y = (set(cells[doc == i].tolist()) for i in (0, 1))
    signature = near_dedup.dart_signatures(doc, cells, 2, 4000)
    assert abs((signature[0] == signature[1]).mean() - len(x & y) / len(x | y)) < 0.03


def brute_repeats(rows, window):
    first = {}
    lists = [words(r["text"]) for r in rows]
    for r, w in zip(rows, lists):
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, 2**63 - 1), order(r["doc_id"]))
    out = []
    for r, w in zip(rows, lists):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < order(r["doc_id"]):
                gone[p : p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(r["doc_id"]), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_repeats(odd_docs, no_docs):
    rows = odd_docs.collect()
    got = substring.digests(substring.find_repeats(odd_docs)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute_repeats(rows, 50)
    left = substring.drop_repeats(odd_docs)
    assert left.columns == odd_docs.columns
    gone = [x for x in brute_repeats(rows, 50) if x[2] and x[1] == x[2]]
    assert left.count() == len(rows) - len(gone)
    assert all(r["n_chars"] == len(r["text"]) for r in left.collect() if r["text"] is not None)
    assert substring.find_repeats(no_docs).count() == 0 and substring.drop_repeats(no_docs).count() == 0


def test_repeats_of_short_windows(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.randrange(40), " ".join(rng.choice("ab") for _ in range(rng.randrange(40)))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (1, 6, 13):
        got = substring.digests(substring.find_repeats(docs, window)).collect()
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute_repeats([{"doc_id": i, "text": t} for i, t in rows], window)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 80))
def test_every_difference_is_covered(period):
    cover = substring.difference_cover(period)
    assert {(a - b) % period for a in cover.tolist() for b in cover.tolist()} == set(range(period))
