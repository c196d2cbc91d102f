"""Centroid clustering, sharding and ranked search against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import centroids, search, sharding
from tests.llm.conftest import prose

VECTORS = "vec_id long, embedding array<double>, cluster string, distance string, whole int, apex int"


def brute_clusters(rows, k, rounds, size):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in named[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        best = assign()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, m) in zip(kept, best) if m == n]
            if mine:
                centres[n] = [sum(xs) // len(mine) for xs in zip(*mine)]
    sums = Counter()
    best = assign()
    for d, n in best:
        sums[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]

    def fits(x):
        return x if x < 2**63 else None

    return sorted((str(i), n, fits(d), fits(sums[n]), fits(sum(sums.values())), digest[n]) for (i, _), (d, n) in zip(kept, best))


def vector_rows(spread=1.0):
    rng = np.random.default_rng(3)
    good = [(int(i), (rng.normal(size=8) * spread).tolist()) for i in range(200)]
    hot = [(1000 + i, good[0][1]) for i in range(300)]
    odd = [(1, good[1][1]), (1, good[1][1]), (None, good[2][1]), (5, None), (6, []), (7, [1.0] * 7), (8, [1.0] * 7 + [None]), (9, [math.nan] * 8), (10, [math.inf] * 8), (11, [0.0] * 8), (10_012, [1.7e308] * 8)]
    return good + hot + odd


def clustered(spark, rows, **kw):
    table = spark.createDataFrame([(i, v, "c", "d", 1, 2) for i, v in rows], VECTORS).repartition(3)
    got = centroids.with_totals(centroids.fit(table, size=8, **kw))
    return sorted((str(r[0]), *r[1:]) for r in got.collect())


def test_clusters_match_brute_force(spark):
    rows = vector_rows()
    for k, rounds, pivots in ((8, 4, 6), (3, 2, 1), (5, 0, 20)):
        assert clustered(spark, rows, k=k, rounds=rounds, pivots=pivots) == brute_clusters([r for r in rows if r[0] != 10_012], k, rounds, 8)


def test_clusters_of_huge_and_of_few_vectors(spark):
    for rows in (vector_rows(1e30)[:60], vector_rows(1e5)[:60] + [(77, [1e38] * 8), (78, [-1e20] + [1.0] * 7)], vector_rows()[:3], [(1, [1.0] * 8)] * 5):
        assert clustered(spark, rows, k=4, rounds=2) == brute_clusters(rows, 4, 2, 8)
    assert clustered(spark, [], k=4, rounds=2) == []


def test_bounds_hold_and_rule_out(spark):
    rng = np.random.default_rng(5)
    for scale in (10.0, 1e6):
        points = np.floor(rng.normal(size=(400, 16)) * scale)
        simplex = centroids.Simplex(np.vstack([points[:5], points[:1], points[0] + (points[1] - points[0])]))
        assert len(simplex.pivots) == 5  # a pivot twice adds nothing
        true = np.sqrt(((points[:, None] - points[None, 300:]) ** 2).sum(-1))
        a, c = simplex.apexes(points), simplex.apexes(points[300:])
        flat = ((a[:, None, :-2] - c[None, :, :-2]) ** 2).sum(-1)
        slack = a[:, None, -1] + c[None, :, -1]
        assert (np.sqrt(flat + (a[:, None, -2] - c[None, :, -2]) ** 2) - slack <= true).all()
        assert (np.sqrt(flat + (a[:, None, -2] + c[None, :, -2]) ** 2) + slack >= true).all()
        near = centroids.left_open(simplex.apexes(points[:5] + 1), simplex.apexes(points[:5]))
        assert near.diagonal().all() and near.sum() < near.size


def test_limbs_add_up():
    for value in (0, 5, -5, 2**55, -(2**55), 2**200 + 17, -(2**200) - 17):
        parts = list(centroids.limbs(np.array([value, 0], object)))
        assert sum(low[0] << (56 * i) for i, low in parts) == value and all(abs(low[0]) <= 2**55 for _, low in parts)


def laws(rows, n_shards):
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values(), default=0) - min((counts[s] for s in range(n_shards)), default=0) <= 1
    assert set(counts) <= set(range(n_shards))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def apart(rows, key):
    """Rows that are not where most of their neighbours are."""
    groups = defaultdict(Counter)
    for r in rows:
        groups[r[key]][r["shard"]] += 1
    return sum(sum(c.values()) - max(c.values()) for c in groups.values())


def test_shards_keep_the_law_and_copies_together(spark):
    texts = [f"copy {g}" for g in range(60) for _ in range(2 + g % 9)] + [f"single {i}" for i in range(700)] + [None] * 4 + [""] * 3
    docs = spark.createDataFrame([(i if i % 50 else 7, t, 1, 2, 3) for i, t in enumerate(texts)], "doc_id long, text string, shard int, link int, row int").repartition(5)
    rows = sharding.query_rows(docs, 10).collect()
    laws(rows, 10)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted((len(t or "") + 16, __import__("zlib").crc32((t or "").encode())) for t in texts)
    assert apart([r for r in rows if r["size"] < 16 + len("single 0")], "text_crc32") == 0  # the least possible: all groups fit
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


def test_shards_of_a_hot_group_and_of_nothing_else(spark):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1000, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    rows = sharding.shard(hot, 12).collect()
    laws(rows, 12)
    mine = Counter(r["shard"] for r in rows if r["text_crc32"] == __import__("zlib").crc32(b"same"))
    assert len(mine) <= 8 and sum(mine.values()) == 1000  # four shards hold 1000 rows at least; parts of half a shard need eight at most
    every = spark.range(600).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 40).cast("string")).alias("text"))
    rows = sharding.shard(every, 8).collect()  # no one without a neighbour to make room
    laws(rows, 8)
    assert apart(rows, "text_crc32") < 600 * 0.6


def test_shards_of_few_rows_and_of_other_links(spark, no_docs, odd_docs):
    assert sharding.query_rows(no_docs).count() == 0
    laws(sharding.query_rows(odd_docs).collect(), 40)
    laws(sharding.query_rows(odd_docs, 1).collect(), 1)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.when(F.col("id") < 100, F.col("id") % 20).alias("host"))
    rows = sharding.shard(docs, 5, link=docs["host"]).collect()
    laws(rows, 5)
    assert apart([{"host": r["doc_id"] % 20, "shard": r["shard"]} for r in rows if r["doc_id"] < 100], "host") == 0


def test_quotas_never_overflow():
    rng = np.random.default_rng(1)
    for _ in range(50):
        wishes = rng.integers(0, 50, (7, 7)) * (rng.random((7, 7)) < 0.4)
        np.fill_diagonal(wishes, 0)
        room = rng.integers(-5, 30, 7)
        granted = sharding.quotas(wishes, room) * wishes
        assert (granted <= wishes + 1e-9).all() and (granted.sum(0) <= np.maximum(room + granted.sum(1), 0) * (1 + 1e-4) + 1e-6).all()


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    held = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            m = 25 + 75 * sum(bag.values()) * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms(text) if t in bag)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, n + 1, None if null else i, -s) for n, (s, null, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


ITEMS = [(1, "w1 W2 w3, w3-w4"), (1, "another text w5"), (2, None), (3, ""), (4, "... !"), (5, "no such term"), (6, "der DER Ä ä É日本 don't x́"), (None, "a b c d"), (1, "w1 W2 w3, w3-w4"), (7, " ".join(f"w{i}" for i in range(300)))]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_search_matches_brute_force(spark, odd_docs, block_bytes):
    items = spark.createDataFrame([(i, t, 1, "x") for i, t in ITEMS], "item_id long, text string, rank int, bag string")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    # blocks change neither statistics nor ranks
    got = search.search(odd_docs, items, block_bytes=block_bytes).collect()
    want = brute_search(docs, list(dict.fromkeys(ITEMS)))
    assert sorted((tuple(r) for r in got), key=str) == want and len(want) > 15


def test_search_among_many_copies_and_ties(spark, no_docs):
    texts = [(i, "alpha beta") for i in range(500)] + [(600 + i, f"alpha {prose(i, 30, 50)}") for i in range(200)] + [(3, "beta alpha"), (None, "alpha beta")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "alpha"), (2, "beta beta w3 w4"), (3, "w1 w2 w3")], "item_id long, text string")
    got = [tuple(r) for r in search.search(docs, items).collect()]
    assert sorted(got, key=str) == brute_search(texts, [(1, "alpha"), (2, "beta beta w3 w4"), (3, "w1 w2 w3")])
    assert search.search(no_docs, items).count() == 0 and search.search(docs, items.limit(0)).count() == 0


def test_scores_beyond_doubles_stay_exact():
    items = search.Items(["t0"])
    weights, m, often = np.array([2**31], np.int64), np.array([25]), np.array([3])
    assert int(search.impacts(weights, often, m)[0]) == 2**31 * (3_000_000_000 // 3200)
    assert len(items) == 1 and items.n_items == 1
