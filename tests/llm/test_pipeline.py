"""The pipeline's stages against brute force, one after the other, on a small table."""

import random

from tokenizers import Tokenizer

import corpus_pipeline
from keelson.functions.storage import work_folder
from keelson.llm import gam, tokens
from tests.llm.conftest import WORDS, prose
from tests.llm.test_dedup import brute_classes, brute_exact, brute_repeats, order


def table(spark):
    rng = random.Random(3)
    shared = prose(1000, 70)
    rows = []
    for i in range(120):
        if i % 6 == 0:
            text = " ".join(w for w in prose(i, 60).split() for _ in range(8))
        elif i % 11 == 0:
            text = prose(i, 40) + "\n" + shared + "\n" + prose(i + 500, 60)
        else:
            text = prose(i, rng.randrange(60, 200))
        rows.append((i, text))
    rows += [(200 + i, rows[i][1].replace(" ", "  ", i)) for i in range(0, 40)]
    rows += [(300 + i, rows[i][1] + " tail") for i in range(0, 40)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (None, prose(77, 90)), (401, None), (402, "")]
    docs = spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    labels = spark.createDataFrame([(i, int(i % 6 != 0), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    folder = work_folder(spark, "pipeline-test")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_against_brute_force(spark):
    folder = table(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = docs.collect()
        out = stage(spark, docs, folder)
        path = work_folder(spark, "stage-test")
        out.write.parquet(path)
        out = spark.read.parquet(path)
        got = out.collect()
        if k < 4:
            assert out.columns == columns
        texts = lambda some: sorted((str(r["doc_id"]), r["text"] or "") for r in some)
        if k == 0:
            model = gam.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            scores = {(r["doc_id"], r["text"]): r["_score"] for r in gam.with_scores(docs, model).collect()}
            assert texts(got) == texts(r for r in rows if scores[r["doc_id"], r["text"]] >= 0.3)
            assert not [r for r in got if r["doc_id"] in range(0, 120, 6)] and len({r["doc_id"] for r in got} & set(range(120))) == 100
        elif k == 1:
            assert sorted("".join(WORDS.findall(r["text"] or "")) for r in got) == sorted(brute_exact(rows))
        elif k == 2:
            _, n = brute_classes(rows)
            classes, _ = brute_classes(rows)
            assert len(got) == n and {str(r["doc_id"]) for r in got} == {str(c) for c in classes}
        elif k == 3:
            want = {w[0]: w for w in brute_repeats(rows, 50)}
            assert any(w[2] for w in want.values())
            assert {str(r["doc_id"]) for r in got} == {i for i, w in want.items() if not w[2] or w[2] < w[1]}
            assert all(len(WORDS.findall(r["text"] or "")) == want[str(r["doc_id"])][1] - want[str(r["doc_id"])][2] for r in got)
        else:
            library = Tokenizer.from_file(tokens.default_path())
            assert sum(r["length"] for r in got) == sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in rows)
            assert sorted((str(r["doc_id"]) for r in got if r["piece"] == 0), key=str) == sorted(str(r["doc_id"]) for r in rows)
        docs = out
    assert sorted(str(r["doc_id"]) for r in corpus_pipeline.run(spark, folder).collect()) == sorted(str(r["doc_id"]) for r in docs.collect())
    assert order(None) > order(5)


def test_empty_table(spark):
    folder = work_folder(spark, "pipeline-test")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
