"""Exact duplicates by composable polynomial fingerprints.

The normalised text (white space ``[\\x20\\x09-\\x0D]`` deleted, UTF-8) is cut into chunks.  A chunk's hash is its
bytes read as a polynomial modulo a prime, for several bases; the hash of a whole is the sum of its chunks' hashes,
each shifted by the number of bytes behind it.  So the chunks of a huge document are hashed on their own and a
distributed sum composes them.  Documents of one fingerprint are then compared with the one that stays, chunk by
chunk as rows; those that differ from it form a group of their own, until every group holds equal texts only.

Of equal texts the row with the most code points in the original stays, then the smallest id, null ids last; of
repeated rows (same id, same text) one stays.  Null text counts as empty.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.storage import cut
from keelson.llm.rows import SPACES, free_name, row_key, sliced, texts_of

PRIME = (1 << 31) - 1
BASES = (1_000_003, 16_777_619, 1_103_515_245, 2_038_074_743)
CHUNK_BYTES = 1 << 16


def normalised(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def with_chunks(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``rows`` (with binary ``norm``) once per chunk: chunk_no, chunk; an empty text has one empty chunk."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.octet_length("norm") / chunk_bytes).cast("int") - 1))
    chunks = F.transform(starts, lambda i: F.substring(F.col("norm"), i * chunk_bytes + 1, F.lit(chunk_bytes)))
    return rows.select("*", F.posexplode(chunks).alias("chunk_no", "chunk")).drop("norm")


def power(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    """base ** exponent modulo the prime, for each exponent."""
    result, square, left = np.ones(len(exponents), np.int64), base % prime, exponents.copy()
    while left.any():
        result = np.where(left & 1, result * square % prime, result)
        square, left = square * square % prime, left >> 1
    return result


def chunk_hashes(chunks: pa.Array, after: np.ndarray, bases: Sequence[int], prime: int) -> list[np.ndarray]:
    """For each base the chunks' hashes, shifted by the bytes that follow each chunk in its document."""
    offsets = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset : chunks.offset + len(chunks) + 1].astype(np.int64)
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    data = np.frombuffer(chunks.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.int64) + 1 if len(full) else np.zeros(0, np.int64)
    begin = (offsets - offsets[0])[:-1]
    behind = np.repeat(begin + sizes - 1, sizes) - np.arange(len(data))
    table = np.arange(int(sizes.max(initial=0)) + 1)
    hashes = []
    for base in bases:
        powers = power(base, table, prime)
        value = np.zeros(len(chunks), np.int64)
        if len(full):
            value[full] = np.add.reduceat(data * powers[behind], begin[full]) % prime
        hashes.append(value * power(base, after, prime) % prime)
    return hashes


def fingerprints(docs: DataFrame, bases: Sequence[int] = BASES, prime: int = PRIME, chunk_bytes: int = CHUNK_BYTES, sha256: bool = False) -> DataFrame:
    """One row per row of ``docs``: rid, row_key, doc_id, n_chars, n_bytes, text_sha256 (or null), h0, h1, ..."""
    rows = texts_of(docs).withColumn("rid", F.monotonically_increasing_id()).withColumn("norm", normalised(F.col("text")).cast("binary"))
    digest = F.sha2("norm", 256) if sha256 else F.lit(None).cast("string")
    rows = rows.select("rid", "row_key", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.octet_length("norm").cast("long").alias("n_bytes"), digest.alias("text_sha256"), "norm")
    hashes = [f"h{i}" for i in range(len(bases))]
    keys = ["rid", "row_key", "doc_id", "n_chars", "n_bytes", "text_sha256"]
    chunks = with_chunks(rows, chunk_bytes).select(*keys, "chunk_no", "chunk")
    schema = T.StructType([*chunks.select(keys).schema.fields, *(T.StructField(n, T.LongType()) for n in hashes)])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "chunk"):
            end = (batch.column("chunk_no").to_numpy().astype(np.int64) + 1) * chunk_bytes
            after = np.maximum(0, batch.column("n_bytes").to_numpy() - end)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *map(pa.array, chunk_hashes(batch.column("chunk"), after, bases, prime))], names=names)

    return chunks.mapInArrow(run, schema).groupBy(*keys).agg(*((F.sum(n) % prime).alias(n) for n in hashes))


def _groups(rows: DataFrame, by: list[str]) -> DataFrame:
    """Groups of two or more: their size and the row that stays."""
    best = F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key", "rid")
    groups = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("group_size"), F.min(best).alias("best")).where("group_size > 1")
    return groups.select(*by, "group_size", F.col("best.rid").alias("keep_rid"), F.col("best.doc_id").alias("keep_id"), F.col("best.row_key").alias("keep_key"))


def _different(docs: DataFrame, members: DataFrame, chunk_bytes: int) -> DataFrame:
    """rid of the members (rid, row_key, keep_rid, keep_key) whose text differs from the kept row's, chunk by chunk."""
    wanted = members.select("row_key").union(members.select(F.col("keep_key"))).distinct()
    texts = texts_of(docs).select("row_key", normalised(F.col("text")).cast("binary").alias("norm")).join(wanted, "row_key", "left_semi").dropDuplicates(["row_key"])
    chunks = cut(with_chunks(texts, chunk_bytes))
    kept = members.select("keep_key").distinct().join(chunks.withColumnRenamed("row_key", "keep_key"), "keep_key").withColumnRenamed("chunk", "keep_chunk")
    pairs = members.select("row_key", "keep_key").distinct()
    own = pairs.join(chunks, "row_key")
    odd = own.join(kept, ["keep_key", "chunk_no"], "left").where(~F.col("chunk").eqNullSafe(F.col("keep_chunk"))).select("row_key", "keep_key").distinct()
    return members.join(odd, ["row_key", "keep_key"], "left_semi").select("rid")


def find_duplicates(docs: DataFrame, bases: Sequence[int] = BASES, prime: int = PRIME, chunk_bytes: int = CHUNK_BYTES, sha256: bool = False) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, keep_id, group_size, kept, text_sha256 (null unless asked for)."""
    by = ["n_bytes", *(f"h{i}" for i in range(len(bases))), "round"]
    rows = cut(fingerprints(docs, bases, prime, chunk_bytes, sha256).withColumn("round", F.lit(0)))
    turn = 0
    while True:
        groups = cut(_groups(rows, by))
        members = rows.where(F.col("round") == turn).join(groups, by).where("rid <> keep_rid").select("rid", "row_key", "keep_rid", "keep_key")
        odd = cut(_different(docs, members, chunk_bytes))
        if odd.isEmpty():
            break
        turn += 1
        rows = cut(rows.join(odd.withColumn("odd", F.lit(turn)), "rid", "left").withColumn("round", F.coalesce("odd", "round")).drop("odd"))
    joined = rows.join(groups, by, "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "row_key", "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = cut(find_duplicates(docs).select("row_key", "kept"))
    by_key = found.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("stays"))
    gone = by_key.where("not stays").select("row_key")
    repeated = cut(by_key.where("stays and n > 1").select("row_key"))
    return without(docs, gone, repeated)


def without(docs: DataFrame, gone: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """``docs`` without the rows whose key is in ``gone``; of those whose key is in ``repeated`` one row each."""
    key = free_name("_row_key", docs)
    marked = docs.withColumn(key, row_key(docs["doc_id"], docs["text"].cast("string")))
    left = marked.join(gone.select(F.col("row_key").alias(key)), key, "left_anti")
    if repeated is not None and not repeated.isEmpty():
        twice = repeated.select(F.col("row_key").alias(key))
        left = left.join(twice, key, "left_anti").unionByName(left.join(twice, key, "left_semi").dropDuplicates([key]))
    return left.drop(key)
