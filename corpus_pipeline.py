"""The corpus pipeline: from raw documents to packed training sequences.

Quality model, exact dedup, near dedup, substring dedup, best-fit packing.  Each stage takes and gives rows of
``documents`` (whatever columns there are), the last one gives pieces of sequences.  Nulls, empty texts, ties,
repeated rows and empty tables are treated as each operator's module says: a null text counts as empty and stays
unless the model rejects it, of repeated rows the exact stage keeps one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.storage import cut
from keelson.llm import exact_dedup, gam, near_dedup, packing, substring

#: From this score up a document is kept.
QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the model does not reject; it learns from the labelled ones that are not held out."""
    model = gam.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = gam.with_scores(docs, model, "_quality_score")
    score = next(c for c in scored.columns if c not in docs.columns)
    return scored.where(F.col(score) >= QUALITY).drop(score)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages that an earlier one has; those with nothing left go."""
    return substring.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("substring dedup", passages),
    ("best-fit packing", pack),
]

#: Learned scores, hashed signatures and token ids are beyond SQL; tests/llm compares with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
