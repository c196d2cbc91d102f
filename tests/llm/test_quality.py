"""Learned rules and the additive model: counts against brute force, learning on held-out rows."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.llm import gam, rules
from tests.llm.conftest import WORDS, prose

SF = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    w = WORDS.findall(text)
    triples = Counter(zip(w, w[1:], w[2:]))
    covered = [False] * len(w)
    for i in range(len(w) - 2):
        if triples[tuple(w[i : i + 3])] > 1:
            covered[i : i + 3] = [True] * 3
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(c in rules.SYMBOLS for c in text), len(lines) - len(set(lines)), sum(covered)


def test_counts(spark, odd_docs, no_docs, labels):
    extra = [(100, "a b c a b c"), (101, "a b a b a b a"), (102, "x\nx\n\n \nx y\nx y\n"), (103, "#a & <b>| $%*"), (104, "a a a"), (105, "a b"), (106, "a b c d"), (107, "  a b \U00010400")]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    want = sorted((str(r["doc_id"]), *base(r["text"])) for r in docs.collect())
    got = rules.apply_rules(docs, labels).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert rules.apply_rules(no_docs, labels).count() == 0


def test_no_labels_keep_everything_the_base_rules_keep(odd_docs, labels):
    got = rules.apply_rules(odd_docs, labels.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] for r in got)


def test_rules_find_the_bad_kind_and_are_plain_conditions(spark):
    rows = [(i, prose(i, 80) if i % 4 else " | ".join(prose(i, 80).split())) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 400, 2)], "doc_id long, quality int")
    stats = rules.statistics(docs)
    found = rules.learn(stats, labels)
    assert found and all(s in rules.STATISTICS for r in found for s, _, _ in r.conditions)
    got = rules.apply_rules(docs, labels).where("not base_failed").collect()
    assert all(r["kept"] == (r["doc_id"] % 4 > 0) for r in got)
    plan = rules.apply_rules(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_agree_with_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learned = labels.where("doc_id % 2 = 0")
    got = rules.apply_rules(docs, learned).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in got]) > 0.95


def test_model_of_odd_documents(odd_docs, no_docs, labels):
    rows = gam.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert gam.classify(no_docs, labels).count() == 0
    assert {r["score"] for r in gam.classify(odd_docs, labels.limit(0)).collect()} == {0.5}
    model = gam.learn(odd_docs, labels)
    kept = gam.with_scores(odd_docs, model)
    assert kept.columns == [*odd_docs.columns, "_score"] and kept.count() == len(rows)
    assert sorted(r["_score"] for r in kept.collect()) == pytest.approx(sorted(r["score"] for r in rows))


def test_held_out_rows_teach_nothing(spark, odd_docs, labels):
    flipped = labels.withColumn("quality", F.when(gam.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert [r["score"] for r in gam.classify(odd_docs, labels).orderBy("score").collect()] == [r["score"] for r in gam.classify(odd_docs, flipped).orderBy("score").collect()]


def test_model_ranks_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = gam.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    ones = [r["score"] for r in rows if r["quality"] == 1]
    zeros = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros]) > 0.97
    assert np.mean([a >= 0.3 for a in ones]) > 0.97


def test_features_of_single_texts_do_not_depend_on_their_neighbours():
    texts = ["a b c", "", None, "X! X! X!\nX! X! X!", "é | é | é"]
    together = gam.features(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert gam.features(pa.array([t], pa.string()))[0] == pytest.approx(together[i])
    assert together[1].tolist() == together[2].tolist() == [0.0] * len(gam.FEATURES)


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000], gam.Settings(pairs=1))
    assert model.pairs == [(0, 1)] and ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
