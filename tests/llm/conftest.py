"""Small documents with every odd case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random
import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, kept string, score string, ids string, stretch int"


def prose(seed: int, n: int, pool: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    base, other, shared = prose(1, 160), prose(2, 200), prose(3, 70)
    near = base.split()
    near[80] = "changed"
    texts = [
        (5, base), (9, base), (9, base), (7, base.replace(" ", "\n ")), (None, base), (None, None), (11, None), (12, ""), (13, " \t\n"),
        (2, " ".join(near)), (20, other), (3, other + " " + shared), (21, prose(4, 90) + "\n" + shared + "\t" + prose(5, 90)),
        (21, "same id, another text"), (22, "a"), (23, "a b c d"), (24, "a b c d"), (25, "Ä é ΑΣ İ 日本 <|endoftext|> x́ \x0b\x0c\r\n don't"),
        (26, prose(6, 30000)), (27, prose(7, 49)), (28, prose(7, 49)), (29, "x" * 70000), (30, "der " * 400), (31, "menu | list | of | things"),
    ]
    return [(i, t, None if k % 3 == 0 else "en", None if k % 5 == 0 else "src", None if t is None else len(t), f"r{k}", "k", "s", "i", 1) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i not in (30, 31)), 0) for i in range(2, 32)] + [(None, 1, 0), (40, None, None), (2, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
