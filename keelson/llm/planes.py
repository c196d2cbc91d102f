"""Token ids in files of bit planes.

Layout below a folder, all of it written by Spark and so in any store that Spark reaches:

* ``blocks``: Parquet rows, one per block of ``block`` ids (the last of a shard may be shorter).  ``planes`` is the
  block turned by bits: plane k holds bit k of every id, eight ids to a byte, low bit first, each plane compressed
  by zstandard on its own and the planes joined, lowest first; ``plane_sizes`` has their bytes.  There are as many
  planes as the largest id of the block has bits.  ``shard`` and ``first`` say where the block's ids lie, and the
  ``seg_*`` arrays which documents they belong to.
* ``index``: one row per block without its planes: shard, block, first, n_ids, n_bytes, and start, the ids of all
  shards before.

Documents lie in ascending order of id (null ids first; equal ids by a digest of the text), shard after shard.  Null
and empty texts have the end id alone; a document may run over any number of blocks; an empty table writes no block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm import tokens
from keelson.llm.bpe import binaries
from keelson.llm.rows import names_of, sliced, texts_of

BLOCK = 32_768
LEVEL = 3
_BLOCKS = (
    "shard int, block int, first long, n_ids int, planes binary, plane_sizes array<int>, "
    "seg_doc array<long>, seg_doc_first array<long>, seg_doc_tokens array<long>, seg_start array<long>, seg_size array<int>"
)
_SEGMENTS = "shard int, doc_first long, doc_id long, n_tokens long, seg_start long, ids binary"


def to_planes(ids: np.ndarray, level: int = LEVEL) -> list[bytes]:
    """The compressed bit planes of a block of unsigned 32-bit ids, lowest first."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=level, write_checksum=True)
    bits = int(ids.max()).bit_length() if len(ids) else 0
    octets = np.ascontiguousarray(np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T)
    return [pack.compress(np.packbits(octets[k >> 3] & np.uint8(1 << (k & 7)), bitorder="little").tobytes()) for k in range(bits)]


def from_planes(planes: bytes, sizes: np.ndarray, n_ids: int) -> np.ndarray:
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    octets, at = np.zeros((4, n_ids), np.uint8), 0
    for k, size in enumerate(sizes):
        plane = np.frombuffer(unpack.decompress(planes[at : at + size]), np.uint8)
        octets[k >> 3] |= np.unpackbits(plane, count=n_ids, bitorder="little") << np.uint8(k & 7)
        at += int(size)
    return np.ascontiguousarray(octets.T).reshape(-1).view("<u4")


def _block(shard: int, number: int, first: int, ids: np.ndarray, docs: dict[str, np.ndarray], level: int) -> dict:
    """A row of ``blocks``: ids at ``first`` of the shard; ``docs`` those that begin before its end, in order."""
    last = first + len(ids)
    here = slice(int(np.searchsorted(docs["end"], first, side="right")), int(np.searchsorted(docs["first"], last, side="left")))
    start, end, planes = docs["first"][here], docs["end"][here], to_planes(ids, level)
    return {
        "shard": shard, "block": number, "first": first, "n_ids": len(ids), "planes": b"".join(planes), "plane_sizes": [len(p) for p in planes],
        "seg_doc": docs["doc_id"][here].tolist(), "seg_doc_first": start.tolist(), "seg_doc_tokens": (end - start).tolist(),
        "seg_start": (np.maximum(start, first) - start).tolist(), "seg_size": (np.minimum(end, last) - np.maximum(start, first)).tolist(),
    }


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 1, block: int = BLOCK, level: int = LEVEL) -> None:
    """Encode whole texts, end each document with ``end_id``, and write blocks and index below ``folder``."""
    path = path or tokens.default_path()
    rows = texts_of(docs)
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("row_key")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "row_key")
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("planes", pa.binary()), ("plane_sizes", pa.list_(pa.int32()))] + [(c, pa.list_(pa.int64())) for c in ("seg_doc", "seg_doc_first", "seg_doc_tokens", "seg_start")] + [("seg_size", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = tokens.encoder(path), TaskContext.get().partitionId()
        number = first = done = 0
        waiting = np.zeros(0, np.uint32)
        open_docs = {"doc_id": np.zeros(0, object), "first": np.zeros(0, np.int64), "end": np.zeros(0, np.int64)}
        for batch in sliced(batches, "text"):
            ids, counts = encoder(batch.column("text"))
            ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
            ends = done + np.cumsum(counts)
            done = int(ends[-1])
            new = {"doc_id": np.array([*batch.column("doc_id").to_pylist(), None], object)[:-1], "first": ends - counts, "end": ends}
            open_docs = {k: np.concatenate([v, new[k]]) for k, v in open_docs.items()}
            waiting = np.concatenate([waiting, ids])
            full = len(waiting) // block
            if full:
                yield pa.RecordBatch.from_pylist([_block(shard, number + i, first + i * block, waiting[i * block : (i + 1) * block], open_docs, level) for i in range(full)], schema)
            number, first, waiting = number + full, first + full * block, waiting[full * block :]
            ongoing = open_docs["end"] > first
            open_docs = {k: v[ongoing] for k, v in open_docs.items()}
        if len(waiting):
            yield pa.RecordBatch.from_pylist([_block(shard, number, first, waiting, open_docs, level)], schema)

    ordered.mapInArrow(run, _BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")
    blocks = docs.sparkSession.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    sizes = F.aggregate("plane_sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    blocks.select("shard", "block", "first", "n_ids", sizes.alias("n_bytes")).join(shards, "shard").write.parquet(f"{folder}/index")


def _segments(blocks: DataFrame, whole: bool) -> DataFrame:
    """The decoded ids of documents that lie in one block, or the pieces of those that do not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["seg_size"], np.int64)
                wanted = (sizes == np.array(row["seg_doc_tokens"])) == whole
                if not wanted.any():
                    continue
                ids = from_planes(row["planes"], row["plane_sizes"], row["n_ids"])
                some = np.flatnonzero(wanted).tolist()
                pick = lambda c: pa.array([row[c][i] for i in some], pa.int64())
                blobs = binaries(ids[np.repeat(wanted, sizes)], sizes[wanted])
                yield pa.RecordBatch.from_arrays([pa.array([row["shard"]] * len(some), pa.int32()), pick("seg_doc_first"), pick("seg_doc"), pick("seg_doc_tokens"), pick("seg_start"), blobs], names=names_of(_SEGMENTS))

    return blocks.mapInArrow(run, _SEGMENTS)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    starts = spark.read.parquet(f"{folder}/index").groupBy("shard").agg(F.first("start").alias("shard_start"))
    whole = _segments(blocks, True).drop("seg_start")
    parts = _segments(blocks, False).groupBy("shard", "doc_first", "doc_id", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("seg_start", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda ids, p: F.concat(ids, p["ids"]))
    docs = whole.unionByName(parts.withColumn("ids", joined).drop("parts"))
    return docs.join(starts, "shard").select("doc_id", (F.col("shard_start") + F.col("doc_first")).alias("start"), "n_tokens", "ids")

