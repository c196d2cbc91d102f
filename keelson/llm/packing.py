"""Best-fit-decreasing packing of tokenised documents into sequences.

Best fit decreasing takes the pieces by length, longest first, and puts each into the open sequence with the least
room that still holds it.  A segment tree over the capacities counts the open sequences of each remaining room, so
the tightest one is found in a logarithmic number of steps.  Pieces of one length are interchangeable, hence the
plan needs only how many pieces of each length there are: at most ``capacity`` numbers, whatever the size of the
corpus.  The plan places whole runs of equal pieces into whole ranges of equally filled sequences, which gives just
what placing them one by one would.  Each piece then finds its place by its rank among the pieces of its length.

Null text counts as empty, and every document ends with ``end_id``, so an empty one is a piece of one token.  Only
documents longer than ``capacity`` are cut.  Ties between pieces of a length fall by order of storage; repeated rows
and null ids are pieces like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.storage import cut
from keelson.llm import tokens
from keelson.llm.bpe import binaries
from keelson.llm.rows import names_of, ramps, sliced, texts_of

#: Token ids to a slice of pieces handed back to Spark.
_PIECES = 4096


class RoomTree:
    """Counts of open sequences by remaining room, under a segment tree of 'any here'."""

    def __init__(self, capacity: int) -> None:
        self.width = 1 << max(1, capacity.bit_length())
        self.any = np.zeros(2 * self.width, bool)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def tightest(self, room: int) -> int:
        """The least remaining room of ``room`` or more that an open sequence has, or -1."""
        node = self.width + room
        while not self.any[node]:
            while node & 1:
                node >>= 1
            if not node:
                return -1
            node += 1
        while node < self.width:
            node = 2 * node + (not self.any[2 * node])
        return node - self.width

    def put(self, room: int, first: int, count: int) -> None:
        self.ranges[room].append((first, count))
        self._note(room)

    def take(self, room: int) -> tuple[int, int]:
        got = self.ranges[room].pop()
        self._note(room)
        return got

    def _note(self, room: int) -> None:
        node = self.width + room
        self.any[node] = bool(self.ranges[room])
        while node > 1:
            node >>= 1
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, first rank, pieces, first sequence, pieces to a sequence, offset) of best fit decreasing."""
    tree, opened, runs = RoomTree(capacity), 0, []
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room < 0:
                room = capacity
                first, many = opened, -(-left // (capacity // length))
                opened += many
            else:
                first, many = tree.take(room)
            each = room // length  # a sequence just filled stays the tightest while another piece fits
            full = min(many, left // each)
            if full:
                runs.append((length, rank, full * each, first, each, capacity - room))
                tree.put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
                first, many = first + full, many - full
            if many and left and left < each:
                runs.append((length, rank, left, first, left, capacity - room))
                tree.put(room - left * length, first, 1)
                rank, left, first, many = rank + left, 0, first + 1, many - 1
            if many:
                tree.put(room, first, many)
    return np.array(runs, np.int64).reshape(-1, 6)


def pieces_of(docs: DataFrame, path: str | None = None, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, ids_crc32, and part and nth (where a task met it among those of its length)."""
    path = path or tokens.default_path()
    schema = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, part int, nth long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = tokens.encoder(path), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        for batch in sliced(batches, "text"):
            ids, counts = encoder(batch.column("text"))
            ended = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
            n_pieces = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), n_pieces)
            piece = ramps(n_pieces)
            start = piece * capacity
            length = np.minimum(capacity, counts[row] - start)
            order = np.argsort(length, kind="stable")
            sizes, first, many = np.unique(length[order], return_index=True, return_counts=True)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(order)) - np.repeat(first, many) + np.repeat(met[sizes], many)
            met[sizes] += many
            blobs = binaries(ended, length)
            crc = np.fromiter((zlib.crc32(b.as_buffer()) for b in blobs), np.int64, len(blobs))
            table = pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), blobs, pa.array(crc), pa.array(np.full(len(row), part, np.int32)), pa.array(nth)],
                names=names_of(schema),
            )
            for at in range(0, table.num_rows, _PIECES):
                yield table.slice(at, _PIECES)

    return texts_of(docs).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str | None = None, capacity: int = 2048, end_id: int = 0, ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (unless ``ids`` is off), ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = pieces_of(docs, path, capacity, end_id)
    pieces = cut(pieces if ids else pieces.drop("ids"))
    by_part = cut(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("here")))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("here").alias("n")).collect()}  # ``capacity`` rows at most
    runs = plan(counts, capacity)
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(by_part.select("length", "part", F.coalesce(F.sum("here").over(ahead), F.lit(0)).alias("before")))
    ranked = pieces.join(starts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth")).drop("before", "nth", "part")
    shared = spark.sparkContext.broadcast(runs)  # its size depends on the capacity alone

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(size: pa.Array, rank: pa.Array) -> pa.Array:
        runs = shared.value
        length, first_rank, _, sequence, each, offset = runs[np.lexsort((runs[:, 1], runs[:, 0]))].T
        size, rank = size.to_numpy(), rank.to_numpy()
        at = np.empty(len(size), np.int64)
        for n in np.unique(size).tolist():
            mine = size == n
            first, last = np.searchsorted(length, [n, n + 1])
            at[mine] = first + np.searchsorted(first_rank[first:last], rank[mine], side="right") - 1
        within = rank - first_rank[at]
        return pa.StructArray.from_arrays([pa.array(sequence[at] + within // each[at]), pa.array(offset[at] + within % each[at] * size)], names=["sequence_id", "offset"])

    # only length and rank go to Python here; the ids stay where they are
    placed = ranked.withColumn("placed", place("length", "rank"))
    return placed.select(*[c for c in ranked.columns if c != "rank"], "placed.sequence_id", "placed.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, n_pieces, n_tokens, ids; a sequence has ``capacity`` tokens at most."""
    return packed.groupBy("sequence_id").agg(
        F.count(F.lit(1)).alias("n_pieces"),
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
    ).select("sequence_id", "n_pieces", "n_tokens", F.aggregate("parts", F.lit(b"").cast("binary"), lambda all_ids, p: F.concat(all_ids, p["ids"])).alias("ids"))
