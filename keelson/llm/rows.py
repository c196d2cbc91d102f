"""What the operators share: row keys, slices of Arrow batches, words of a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Between words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
SLICE_BYTES = 2 << 20


def names_of(ddl: str) -> list[str]:
    """The column names of a schema string without nested commas."""
    return [field.split()[0] for field in ddl.split(",")]


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it until no frame has such a column."""
    while any(name.lower() == c.lower() for f in frames for c in f.columns):
        name = "_" + name
    return name


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that name a row by its id and text, null or not; rows that agree in both share it."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), text))).cast("binary")))


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_key, doc_id, text) of every row, under these names whatever other columns there are; null text becomes empty."""
    doc_id, text = docs[id_col], docs[text_col].cast("string")
    return docs.select(row_key(doc_id, text).alias("row_key"), doc_id.cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose ``column`` holds ``most`` bytes at most, or one row.

    At the end the Arrow memory that the task has freed goes back to the system, as workers outlive their tasks.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
    pa.default_memory_pool().release_unused()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in order, and how many each text has; null texts have none."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(parts)
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(real)])
    ends = np.cumsum(sizes)
    counts = upto[ends] - upto[ends - sizes]
    return flat.filter(pa.array(real)), counts.astype(np.int64)


def ramps(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64) - np.repeat(ends - counts, counts)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit xxHash of each word; a word met often in the array is hashed once."""
    import xxhash

    coded = words.dictionary_encode()
    known = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return known[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
