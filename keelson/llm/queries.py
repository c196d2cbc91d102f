"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import keelson
from keelson.functions.storage import work_folder
from keelson.llm import bpe, centroids, chat, exact_dedup, gam, html_main, near_dedup, packing, planes, rules, search, sharding, substring

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package along as a zip file, once a session, so that workers import it wherever they start."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(keelson.__file__).parents[1]
        folder = Path(tempfile.mkdtemp(prefix="keelson-"))  # the driver's own; addPyFile hands the file out
        with zipfile.ZipFile(folder / "keelson.zip", "w") as archive:
            for file in sorted((root / "keelson").rglob("*.py")):
                archive.write(file, file.relative_to(root))
        context.addPyFile(str(folder / "keelson.zip"))
        _SHIPPED.add(context.applicationId)


def query(name: str, sql: str | None = None):
    def register(function):
        @functools.wraps(function)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


EXACT_SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents
), r as (
  select doc_id, sha256(norm) as text_sha256,
    first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size, row_number() over w as nth
  from d window w as (partition by norm order by n_chars desc, doc_id nulls last)
)
select doc_id, keep_id, group_size, nth = 1 as kept, text_sha256 from r
"""


@query("op3_exact_dedup", EXACT_SQL)
def exact(spark, sf_dir):
    return exact_dedup.find_duplicates(documents(spark, sf_dir), sha256=True).drop("row_key")


@query("op4_best_fit_packing")
def packed(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), ids=False)


@query("op5_token_planes")
def token_planes(spark, sf_dir):
    folder = work_folder(spark, "token-planes")
    planes.write(documents(spark, sf_dir), folder)
    return planes.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op6_bpe_round_trip")
def bpe_round_trip(spark, sf_dir):
    return bpe.round_trip_query(documents(spark, sf_dir))


@query("op2_near_dedup")
def near(spark, sf_dir):
    return near_dedup.find_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "kept", "n_words")


@query("op10_substring_dedup")
def repeats(spark, sf_dir):
    return substring.digests(substring.find_repeats(documents(spark, sf_dir)))


@query("op1_quality_rules")
def quality_rules(spark, sf_dir):
    return rules.apply_rules(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op7_quality_model")
def quality_model(spark, sf_dir):
    return gam.classify(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op8_html_main_text")
def html_main_text(spark, sf_dir):
    found = html_main.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op9_chat_repair")
def chat_repair(spark, sf_dir):
    return chat.render_parts(chat.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


@query("op11_centroid_clusters", centroids.twin_sql())
def centroid_clusters(spark, sf_dir):
    return centroids.with_totals(centroids.fit(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


@query("op12_balanced_shards")
def balanced_shards(spark, sf_dir):
    return sharding.query_rows(documents(spark, sf_dir))


@query("op13_ranked_search", search.TWIN_SQL)
def ranked_search(spark, sf_dir):
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
