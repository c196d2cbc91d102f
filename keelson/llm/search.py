"""Ranked lexical search over bags: documents that look the same to the items are scored once.

A document is restricted to the terms of the items, which leaves a short vector of term counts, its *bag*.  With the
length figure m the bag decides every score, so documents are put into classes by a hash of both, and within a hash
by the values themselves.  Each class is scored once against all items, in blocks; what leaves a task are the ten best
classes of each item by score and least doc_id.  That is enough: ten classes before another in this order have ten
documents before all of its own.  The members of the chosen classes are then counted out by ascending doc_id.

Terms are the longest runs of letters and digits of ASCII and of all characters beyond it; only A to Z are lowered.
Null and empty texts and those without a term are no documents of the statistics and never found.  An item without a
term finds nothing.  A repeated document is found as often as it is there; null ids come last among equal scores.  A
repeated item (id and text) is searched once; texts that share an id are searched each on its own.  Without items or
documents the result is empty.  Extra columns are not looked at.

The items are taken in blocks of ``block_bytes`` of text (or one item), each with a pass over the documents, so what
the driver holds and sends to the tasks (terms, weights, postings of a block) has that bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.storage import cut
from keelson.llm.bpe import binaries, integers
from keelson.llm.copies import LAST_ID
from keelson.llm.rows import ramps, sliced, split_words

BLOCK_BYTES = 4 << 20
#: Single products of a slice of classes, and cells of its table of scores.
_PRODUCTS = 2_000_000


def _folding() -> np.ndarray:
    """What each byte of a text becomes: blank between terms, A to Z lowered."""
    table = np.full(256, 0x20, np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = table[0x61:0x7B]
    return table


_FOLD = _folding()


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, and how many each text has; null texts have none."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return split_words(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    octets = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return split_words(pa.StringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(_FOLD[octets].tobytes())))


class Items:
    """A block of items: their terms in order, and for each term the items that hold it and how often."""

    def __init__(self, texts: list[str | None]) -> None:
        words, counts = terms_of(pa.array(texts, pa.string()))
        coded = words.dictionary_encode()
        self.terms: pa.Array = coded.dictionary
        item = np.repeat(np.arange(len(texts)), counts)
        key, often = np.unique(coded.indices.to_numpy() * len(texts) + item, return_counts=True) if len(words) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        term, self.item = np.divmod(key, max(1, len(texts)))
        self.often = often.astype(np.int64)
        self.first = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.n_items, self.longest = len(texts), int(counts.max(initial=0))

    def __len__(self) -> int:
        return len(self.terms)


def bags_of(docs: DataFrame, items: Items, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with a term: doc_id, n (its terms) and bag (number and count of each term that items have)."""
    shared = docs.sparkSession.sparkContext.broadcast(items.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        for batch in sliced(batches, "text"):
            words, counts = terms_of(batch.column("text"))
            coded = words.dictionary_encode()
            numbers = pc.fill_null(pc.index_in(coded.dictionary, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            at = numbers[coded.indices.to_numpy()] if len(words) else numbers[:0]
            row = np.repeat(np.arange(len(counts)), counts)[at >= 0]
            key, often = np.unique(row * max(1, len(terms)) + at[at >= 0], return_counts=True)
            row, at = np.divmod(key, max(1, len(terms)))
            sizes = np.bincount(row, minlength=len(counts))
            bags = binaries(np.column_stack([at, often]).astype("<u4").ravel(), 2 * sizes)
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), bags], names=["doc_id", "n", "bag"])
            yield out.filter(pa.array(counts > 0))

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, "doc_id long, n long, bag binary")


def _held(bags: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term; the driver gets a number per term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            ids, _ = integers(batch.column("bag"))
            held += np.bincount(ids[::2], minlength=n_terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["term", "n"])

    out = np.zeros(n_terms, np.int64)
    for r in bags.select("bag").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def impacts(weights: np.ndarray, often: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence of a term in an item adds to a document's score."""
    return weights * ((1_000_000_000 * often) // (1000 * often + 8 * m))


def _best(items: Items, weights: np.ndarray, top: int):
    """The task that scores classes (hash, m, bag, first_id) and gives the ``top`` best of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {c: np.zeros(0, np.int64) for c in ("item", "score", "first_id", "hash", "m")}
        best["bag"] = np.zeros(0, object)
        bound = np.zeros(items.n_items, np.int64)  # an item's last score that still counts
        exact_in_doubles = int(weights.max(initial=0)) * 1_000_000 * items.longest < 2**53
        postings = np.diff(items.first)
        for batch in batches:
            ids, sizes = integers(batch.column("bag"))
            sizes = sizes // 2
            term, often = ids[::2].astype(np.int64), ids[1::2].astype(np.int64)
            ends = np.cumsum(sizes)
            columns = {c: batch.column(c).to_numpy() for c in ("first_id", "hash", "m")}
            cost = np.cumsum(np.add.reduceat(np.append(postings[term], 0), np.minimum(ends - sizes, len(term))) * (sizes > 0) + items.n_items)
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + _PRODUCTS, side="right")))
                here = slice(int(ends[at] - sizes[at]), int(ends[upto - 1]))
                rows = np.repeat(np.arange(upto - at), sizes[at:upto])
                value = impacts(weights[term[here]], often[here], columns["m"][at:upto][rows])
                spread = postings[term[here]]
                post = np.repeat(items.first[term[here]], spread) + ramps(spread)
                cell = np.repeat(rows, spread) * items.n_items + items.item[post]
                value = np.repeat(value, spread) * items.often[post]
                if exact_in_doubles:
                    scores = np.bincount(cell, value, minlength=(upto - at) * items.n_items).astype(np.int64)
                else:
                    scores = np.zeros((upto - at) * items.n_items, np.int64)
                    np.add.at(scores, cell, value)
                scores = scores.reshape(-1, items.n_items)
                row, item = np.nonzero((scores > 0) & (scores >= bound))
                new = {"item": item, "score": scores[row, item], **{c: v[at:upto][row] for c, v in columns.items()}}
                new["bag"] = np.empty(len(row), object)
                new["bag"][:] = [at + r for r in row.tolist()]
                best = {c: np.concatenate([best[c], new[c]]) for c in best}
                order = np.lexsort((best["hash"], best["first_id"], -best["score"], best["item"]))
                item = best["item"][order]
                nth = np.arange(len(order)) - np.searchsorted(item, item)
                best = {c: v[order[nth < top]] for c, v in best.items()}
                item, nth = best["item"], nth[nth < top]
                bound[item[nth == top - 1]] = best["score"][nth == top - 1]
                at = upto
            bags = batch.column("bag")
            best["bag"][:] = [b if isinstance(b, bytes) else bags[b].as_py() for b in best["bag"].tolist()]
        if len(best["item"]):
            arrays = [pa.array(best[c], pa.binary() if c == "bag" else pa.int64()) for c in best]
            yield pa.RecordBatch.from_arrays(arrays, names=list(best))

    return run


def _search_block(docs: DataFrame, block: list, top: int, id_col: str, text_col: str) -> DataFrame | None:
    """Results for a block of items (item_id, text)."""
    items = Items([r["text"] for r in block])
    if not len(items):
        return None
    spark = docs.sparkSession
    bags = cut(bags_of(docs, items, id_col, text_col))
    totals = bags.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).first()
    if not totals["n"]:
        return None
    held = _held(bags, len(items))
    weights = np.floor(1000 * np.log((2.0 * totals["n"] + 2) / (2.0 * held + 1))).astype(np.int64)
    length = F.expr(f"100 - 75 + (75 * n * {totals['n']}L) div {totals['terms']}L")
    marked = bags.where(F.octet_length("bag") > 0).withColumn("m", length).withColumn("hash", F.xxhash64("bag", "m")).withColumn("rank_id", F.coalesce("doc_id", F.lit(LAST_ID)))
    classes = marked.groupBy("hash", "m", "bag").agg(F.min("rank_id").alias("first_id"))
    found = classes.mapInArrow(_best(items, weights, top), "item long, score long, first_id long, hash long, m long, bag binary")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first_id", "hash", "bag")
    chosen = cut(found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top).drop("nth"))
    wanted = chosen.select("hash", "m", "bag").distinct()
    by_id = Window.partitionBy("hash", "m", "bag").orderBy("rank_id")
    members = marked.join(wanted, ["hash", "m", "bag"]).select("hash", "m", "bag", "doc_id", "rank_id").withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= top).drop("nth")
    in_item = Window.partitionBy("item").orderBy(F.desc("score"), "rank_id")
    hits = chosen.join(members, ["hash", "m", "bag"]).withColumn("rank", F.row_number().over(in_item)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], "item long, item_id long")
    return hits.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = 10, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``top`` best documents of each item (item_id, text): item_id, rank, doc_id, score."""
    queries = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text")).distinct()
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = size // block_bytes + 1
    blocked = queries.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    found = []
    for number in range(n_blocks):
        block = blocked.where(F.col("block") == number).orderBy("item_id", "text").collect()
        result = _search_block(docs, block, top, id_col, text_col)
        if result is not None:
            found.append(result)
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


TWIN_SQL = r"""
with d as (
  select row_number() over () as row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), t as (
  select row, doc_id, unnest(terms) as term from d
), q as (
  select item_id, term, count(*) as often from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
  group by item_id, term
), totals as (
  select count(distinct row) as docs, count(*) as terms from t
), tf as (
  select row, doc_id, term, count(*) as tf from t group by row, doc_id, term
), lengths as (
  select row, count(*) as n from t group by row
), w as (
  select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1))) as bigint) as w from tf, totals group by term, docs
), scored as (
  select item_id, doc_id, row, cast(sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) as bigint) as score
  from q join tf using (term) join w using (term) join lengths using (row), totals group by item_id, doc_id, row
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last, row) as integer) as rank, doc_id, score from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""
