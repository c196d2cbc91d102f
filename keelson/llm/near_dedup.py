"""Near duplicates by DartMinHash signatures, bands and exact verification.

A document is a weighted set: its shingles of five words, each weighing as often as it occurs (other weights work
alike).  Darts are thrown at the plane of weight and rank over each element: a Poisson process of unit rate whose
arrivals are hashes of the element and the weight cell, the same in every document.  A document keeps the darts under
its own weights and below a rank chosen so that about k (ln k + 2) darts remain, and of those the lowest in each of k
coordinates; if a coordinate stays empty the rank is doubled.  Two documents agree in a coordinate with the
probability of their weighted Jaccard similarity.  The work is one hash an element and then one a dart.

Signatures are joined by bands.  Texts with the same words share one unit.  A bucket whose members are not all
in one class yet is cut into blocks of bounded size, and every two blocks of it are compared by their whole weighted
sets: a row with all others at once, until the rest is in one class, so that a large group of near copies settles
after a few of its members.  What leaves a comparison is a star of links for each class found, never all its pairs.
Every pair that shares a bucket is compared or already in one class, and no bucket is capped.

Texts of fewer than five words have all their words as one shingle; texts without words are equal to one another and
to nothing else.  Null text counts as empty; null ids come last; the representative of a class is its least id (then
key), repeated rows are in one class; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.storage import cut
from keelson.llm.copies import LAST_ID, word_copies, words_digests
from keelson.llm.exact_dedup import without
from keelson.llm.rows import mix64, names_of, ramps, sliced, split_words, texts_of, word_hashes
from keelson.llm.substring import Windows
from keelson.operators.clustering import components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: 24 bands of 5 coordinates: a pair of similarity 0.8 shares a bucket with probability 0.9999, one of 0.3 with 0.06.
BANDS, ROWS = 24, 5
#: Weight cells (shingles with their copies) to a block of a bucket; two blocks are compared in one task.
BLOCK_CELLS = 1_000_000
_GOLDEN = 0x9E3779B97F4A7C15


def shingles(words: pa.Array, counts: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and how many each text has."""
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(np.cumsum(counts) - counts, n) + ramps(n)
    hashes = Windows(word_hashes(words), _GOLDEN)
    length = np.repeat(np.minimum(counts, size), n)
    found = np.zeros(len(first), np.uint64)
    for k in np.unique(length):
        found[length == k] = hashes(first[length == k], int(k)).view(np.uint64)
    return found, n


def weighted_cells(found: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash of each unit cell of weight: the second copy of a shingle is another cell than the first."""
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(new)
    copy = ramps(np.diff(np.concatenate([starts, [len(found)]]))).astype(np.uint64)
    return doc, np.where(copy == 0, found, mix64(found + copy * np.uint64(_GOLDEN)))


def dart_signatures(doc: np.ndarray, cells: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """The k coordinates of each document (zeros where it has no cells)."""
    weight = np.bincount(doc, minlength=n_docs)
    signature = np.zeros((n_docs, k), np.uint64)
    todo = weight > 0
    limit = k * (math.log(k) + 2) / np.maximum(weight, 1)
    while todo.any():
        mine = todo[doc]
        owner, cell = doc[mine], cells[mine]
        rank = np.zeros(len(owner))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        arrival = 0
        while len(owner):
            arrival += 1
            dart = mix64(cell + np.uint64(arrival * _GOLDEN % (1 << 64)))
            rank = rank - np.log1p(-(dart >> np.uint64(11)).astype(np.float64) * 2.0**-53)
            low = rank < limit[owner]
            owner, cell, rank, dart = owner[low], cell[low], rank[low], dart[low]
            found.append((owner, rank, dart))
        owner, rank, dart = (np.concatenate(x) for x in zip(*found))
        dart = mix64(dart ^ np.uint64(_GOLDEN))
        slot = owner * k + (dart % np.uint64(k)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")
        best = np.zeros(n_docs * k, np.uint64)
        best[slot[order]] = dart[order] | np.uint64(1)
        best = best.reshape(n_docs, k)
        done = todo & (best != 0).all(axis=1)
        signature[done] = best[done]
        todo &= ~done
        limit = limit * 2
    return signature


def scan(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row: row_key, doc_id, rank_id, n_words, words_sha, bands (a hash for each band; none without words)."""
    schema = "row_key binary, doc_id long, n_words long, words_sha binary, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words, counts = split_words(batch.column("text"))
            found, n = shingles(words, counts)
            signature = dart_signatures(*weighted_cells(found, n), len(n), bands * rows).reshape(len(n), bands, rows)
            key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_GOLDEN) + np.zeros((len(n), 1), np.uint64)
            for r in range(rows):
                key = mix64(key ^ signature[:, :, r])
            some = n > 0
            ends = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(key[some].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("doc_id"), pa.array(counts), words_digests(words, counts), lists], names=names_of(schema))

    return texts_of(docs).mapInArrow(run, schema).withColumn("rank_id", F.coalesce("doc_id", F.lit(LAST_ID)))


def _bags(texts: DataFrame) -> DataFrame:
    """(node, bag): the weighted set of each text as hashes of its weight cells."""
    schema = "node long, bag array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found, n = shingles(*split_words(batch.column("text")))
            _, cells = weighted_cells(found, n)
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells.view(np.int64)))], names=names_of(schema))

    return texts.select("node", "text").mapInArrow(run, schema)


def linked_groups(cells: np.ndarray, sizes: np.ndarray, labels: np.ndarray, threshold: float) -> np.ndarray:
    """The rows of a block by class: rows that a chain of links or equal labels joins get one number.

    One row after the other is compared with all rows at once, those outside the largest class first, until the rows
    not yet compared are of one class; so no link between two classes can be missed.
    """
    _, codes = np.unique(cells, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    group = np.unique(labels, return_inverse=True)[1]
    marked = np.zeros(int(codes.max(initial=-1)) + 1, np.int64)
    waiting = np.ones(len(sizes), bool)
    while True:
        names, counts = np.unique(group[waiting], return_counts=True)
        if len(names) < 2:
            return group
        row = int(np.flatnonzero(waiting & (group != names[np.argmax(counts)]))[0])
        mine = codes[starts[row] : starts[row] + sizes[row]]
        marked[mine] = 1
        shared = np.add.reduceat(marked[codes], starts)
        marked[mine] = 0
        alike = shared >= threshold * (sizes + sizes[row] - shared)
        group[np.isin(group, group[alike])] = group[row]
        waiting[row] = False


def _links(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b, a_label, b_label): links that join the labels met in a block, each class as a star around its least label.

    ``members`` has (bucket, i, j, node, label, bag), a group being two blocks of a bucket, of bounded size.
    """
    schema = "a long, b long, a_label long, b_label long"
    names = names_of(schema)

    def run(group: pa.Table) -> pa.Table:
        node, label = (group.column(c).to_numpy() for c in ("node", "label"))
        bags = group.column("bag").combine_chunks()
        sizes = pc.list_value_length(bags).to_numpy()
        found = linked_groups(pc.list_flatten(bags).to_numpy(), sizes, label, threshold)
        order = np.lexsort((node, label, found))
        node, label, found = node[order], label[order], found[order]
        first = np.ones(len(found), bool)
        first[1:] = found[1:] != found[:-1]
        new = np.ones(len(found), bool)
        new[1:] = first[1:] | (label[1:] != label[:-1])
        head = np.flatnonzero(first)[np.cumsum(first) - 1]
        some = new & ~first
        return pa.table([pa.array(x, pa.int64()) for x in (node[head[some]], node[some], label[head[some]], label[some])], names=names)

    return members.groupBy("bucket", "i", "j").applyInArrow(run, schema)


def _merged(links: DataFrame) -> DataFrame:
    """(label, to): labels linked to a star's label, brought to the least label of each star."""
    stars = links.groupBy("a_label").agg(F.least(F.min("b_label"), F.col("a_label")).alias("to"))
    others = links.select("a_label", F.col("b_label").alias("label")).join(stars, "a_label").select("label", "to")
    return others.unionByName(stars.withColumnRenamed("a_label", "label")).groupBy("label").agg(F.min("to").alias("to"))


def _classes(live: DataFrame, bags: DataFrame, threshold: float, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(node, label) of the nodes in buckets (node, band, bucket) that a link joins; label is the least node of the class.

    The labels carried along say which nodes are known to be connected, and spare comparisons; the classes are the
    components of all links found.  The first turn looks at one band, the second at three: most of a large group is in
    one class by then, and its buckets in the other bands need no comparison.
    """
    labels = cut(bags.select("node", F.col("node").alias("label"), F.size("bag").alias("cells")))
    links = None
    for low, high in ((0, 1), (1, 4), (4, 1 << 30)):
        active = live.where((F.col("band") >= low) & (F.col("band") < high)).join(labels, "node")
        buckets = active.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum("cells").alias("cells"))
        blocks = F.ceil(F.col("cells") / block_cells).cast("int").alias("blocks")
        open_buckets = cut(buckets.where("lo < hi").select("bucket", blocks))
        if open_buckets.isEmpty():
            continue
        mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(mine, k).alias("i"), F.greatest(mine, k).alias("j")))
        members = active.join(open_buckets, "bucket").select("bucket", "node", "label", F.inline(cells))
        found = cut(_links(members.join(bags, "node"), threshold).distinct())
        links = found if links is None else links.unionByName(found)
        labels = cut(labels.join(_merged(found), "label", "left").select("node", F.coalesce("to", "label").alias("label"), "cells"))
    if links is None:
        return labels.select("node", "label").limit(0)
    edges = links.select(F.lit(0).alias("run"), F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ends = edges.select("run", F.col("a").alias("id")).union(edges.select("run", F.col("b").alias("id"))).distinct()
    return components(ends, edges).select(F.col("id").alias("node"), "label")


def find_classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, n_words, class_id (id of the class's representative), class_key, kept."""
    scanned = cut(scan(docs, bands, rows).withColumn("node", F.monotonically_increasing_id()))
    copies = cut(word_copies(scanned))
    # rows that agree in id and text share a key: one node stands for all of them, so their text is shingled once
    repeated = scanned.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first")).where("n > 1").select("row_key", "first")
    units = scanned.join(copies.select("row_key"), "row_key", "left_anti").join(cut(repeated), "row_key", "left").where("first is null or node = first").drop("first")
    banded = units.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = cut(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"))
    live = cut(banded.join(shared, "bucket"))
    keys = live.select("node").distinct().join(scanned.select("node", "row_key"), "node")
    texts = texts_of(docs).select("row_key", "text").join(keys, "row_key").dropDuplicates(["node"])
    bags = cut(_bags(texts))
    labels = _classes(live, bags, threshold, block_cells)

    of_unit = units.select("node", "row_key", "rank_id", "doc_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_unit = cut(of_unit.select("label", "row_key", "rank_id", "doc_id"))
    best = F.min(F.struct("rank_id", "row_key", "doc_id")).alias("best")
    heads = cut(of_unit.groupBy("label").agg(best).select("label", F.col("best.row_key").alias("class_key"), F.col("best.doc_id").alias("class_id")))
    classes = cut(of_unit.join(heads, "label").select(F.col("row_key").alias("unit_key"), "class_key", "class_id").distinct())
    alike = scanned.select("row_key", "doc_id", "n_words").join(copies.select("row_key", "unit_key"), "row_key", "left").withColumn("unit_key", F.coalesce("unit_key", "row_key"))
    found = alike.join(classes, "unit_key")
    return found.select("row_key", "doc_id", "n_words", "class_id", "class_key", (F.col("row_key") == F.col("class_key")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The row of each class that stays, with all columns of ``docs``; of repeated rows one stays."""
    found = cut(find_classes(docs, threshold).select("row_key", "kept"))
    repeated = found.where("kept").groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row_key")
    return without(docs, found.where("not kept").select("row_key").distinct(), cut(repeated))
