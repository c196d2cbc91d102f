"""Removal of passages that an earlier document has, by difference-cover anchors.

A window is ``window`` words in a row.  A set of residues modulo a period is a difference cover if every difference
is one between two of its members.  Short windows are hashed only where the position modulo the period is in the
cover: of any two equal windows, however they lie, some offset below the period puts an anchor at the same place in
both.  So a window that another document has always holds an anchor that the other document has as well, and only
windows around such shared anchors are looked at further: their full hashes (128 bits) are summed up to the least id
that has each, and a word goes if a window over it also starts in a document with a smaller id.

Texts with the same words are handled once.  Windows are judged on the input.  Null ids come after every other and
are not smaller than one another; null and empty texts and those shorter than a window lose nothing; repeated rows
and equal ids are not smaller than each other, so they lose what one of them would; an empty table gives an empty
result.  Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.storage import cut
from keelson.llm.copies import LAST_ID, word_copies, words_digests
from keelson.llm.rows import free_name, mix64, names_of, ramps, row_key, sliced, split_words, texts_of, word_hashes

#: A perfect difference cover: each difference modulo 31 once.
PERFECT_31 = (1, 5, 11, 24, 25, 27)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def difference_cover(period: int) -> np.ndarray:
    """Residues whose differences give every residue: about two square roots of the period, six for 31."""
    if period == 31:
        return np.array(PERFECT_31)
    step = int(np.ceil(np.sqrt(period)))
    return np.unique(np.concatenate([np.arange(min(step, period)), np.arange(0, period, step), [period - 1]]))


def period_of(window: int) -> int:
    """31 where it leaves anchors of a third of the window or more, else half the window."""
    return 31 if window >= 46 else max(1, window // 2)


def anchor_places(n_words: int, window: int) -> np.ndarray:
    """Where a text of so many words has anchors."""
    period = period_of(window)
    places = np.arange(max(0, n_words - (window - period + 1) + 1) if n_words >= window else 0)
    return places[np.isin(places % period, difference_cover(period))]


class Windows:
    """Hashes of word windows of any place and size: polynomials modulo 2 ** 64, brought to the same power and mixed."""

    def __init__(self, hashes: np.ndarray, base: int) -> None:
        n = len(hashes)
        odd = np.full(n, base, np.uint64)
        back = np.full(n, pow(base, -1, 1 << 64), np.uint64)
        odd[:1] = back[:1] = 1
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * np.multiply.accumulate(odd), dtype=np.uint64)])
        self.back = np.multiply.accumulate(back)

    def __call__(self, places: np.ndarray, size: int) -> np.ndarray:
        return mix64((self.sums[places + size] - self.sums[places]) * self.back[places]).view(np.int64)


def scan(docs: DataFrame, window: int) -> DataFrame:
    """One row per row: row_key, doc_id, rank_id, n_words, words_sha, anchors (hashes in order of place)."""
    schema = "row_key binary, doc_id long, n_words long, words_sha binary, anchors array<long>"
    period = period_of(window)
    size, cover = window - period + 1, difference_cover(period)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_cover = np.isin(np.arange(period), cover)
        for batch in sliced(batches, "text"):
            words, counts = split_words(batch.column("text"))
            hashes = Windows(word_hashes(words), _BASES[0])
            n_places = np.where(counts >= window, counts - size + 1, 0)
            local = ramps(n_places)
            chosen = in_cover[local % period]
            places = (np.repeat(np.cumsum(counts) - counts, n_places) + local)[chosen]
            ends = np.concatenate([[0], np.cumsum(chosen)])[np.concatenate([[0], np.cumsum(n_places)])]
            anchors = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes(places, size)))
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("doc_id"), pa.array(counts), words_digests(words, counts), anchors], names=names_of(schema))

    return texts_of(docs).mapInArrow(run, schema).withColumn("rank_id", F.coalesce("doc_id", F.lit(LAST_ID)))


def _candidate_windows(suspects: DataFrame, window: int) -> DataFrame:
    """(w0, w1, unit, rank_id, place) of every window that holds a shared anchor."""
    schema = "w0 long, w1 long, unit long, rank_id long, place long"
    period = period_of(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words, counts = split_words(batch.column("text"))
            pair = [Windows(word_hashes(words, seed), base) for seed, base in enumerate(_BASES)]
            begin = np.cumsum(counts) - counts
            near = np.zeros(len(words) + 1, np.int64)
            for first, n, shared in zip(begin.tolist(), counts.tolist(), batch.column("shared")):
                at = anchor_places(n, window)[np.array(shared.as_py(), np.int64)]
                np.add.at(near, first + np.maximum(0, at - period + 1), 1)
                np.add.at(near, first + np.minimum(at, n - window) + 1, -1)
            places = np.flatnonzero(np.cumsum(near) > 0)
            row = np.searchsorted(begin, places, side="right") - 1
            for some in np.array_split(np.arange(len(places)), max(1, len(places) // 100_000)):
                at, mine = places[some], pa.array(row[some])
                hashes = [pa.array(w(at, window)) for w in pair]
                yield pa.RecordBatch.from_arrays([*hashes, batch.column("unit").take(mine), batch.column("rank_id").take(mine), pa.array(at - begin[row[some]])], names=names_of(schema))

    return suspects.select("unit", "rank_id", "text", "shared").mapInArrow(run, schema)


def _cut_out(hit: DataFrame, window: int) -> DataFrame:
    """(row_key, n_removed, spans, kept_text): the words of each text without those under the windows at ``places``."""
    schema = "row_key binary, n_removed long, spans array<struct<start: long, end: long>>, kept_text string"
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words, counts = split_words(batch.column("text"))
            begin = np.cumsum(counts) - counts
            removed, spans, kept = [], [], []
            for first, n, places in zip(begin.tolist(), counts.tolist(), batch.column("places")):
                edge = np.zeros(n + 1, np.int64)
                at = np.array(places.as_py(), np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge)[:n] > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                removed.append(int(gone.sum()))
                spans.append([{"start": s, "end": e} for s, e in turns.reshape(-1, 2).tolist()])
                kept.append(" ".join(words.slice(first, n).filter(pa.array(~gone)).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), pa.array(removed, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.string())], names=["row_key", "n_removed", "spans", "kept_text"])

    return hit.select("row_key", "text", "places").mapInArrow(run, schema)


def find_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, n_words, n_removed, spans (word places that go), kept_text, words_sha.

    kept_text holds the kept words joined by blanks where some words go and others stay, and is null elsewhere;
    words_sha is the SHA-256 of all words joined by blanks.
    """
    scanned = cut(scan(docs, window).withColumn("unit", F.monotonically_increasing_id()))
    copies = cut(word_copies(scanned.where(F.col("n_words") >= window)))
    anchors = scanned.where(F.size("anchors") > 0)
    # An anchor counts as shared if two texts of different words have it: copies need no look at all.
    text_id = F.xxhash64("words_sha").alias("text_id")
    seen = anchors.select(text_id, F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.min("text_id").alias("least"), F.max("text_id").alias("most"))
    shared = cut(seen.where("least < most").select("anchor"))
    found = anchors.select("unit", F.posexplode("anchors").alias("nth", "anchor")).join(shared, "anchor")
    flagged = cut(found.groupBy("unit").agg(F.collect_set("nth").alias("shared")))
    named = flagged.join(scanned.select("unit", "row_key", "rank_id"), "unit").join(copies.select("row_key"), "row_key", "left_anti")
    named = named.dropDuplicates(["row_key"])  # rows that agree in id and text are looked at once
    texts = texts_of(docs).select("row_key", "text")
    suspects = cut(named.join(texts, "row_key").dropDuplicates(["row_key"]))
    windows = _candidate_windows(suspects, window)
    least = windows.groupBy("w0", "w1").agg(F.min("rank_id").alias("least"), F.max("rank_id").alias("most"))
    least = cut(least.where("least < most").drop("most"))
    hits = windows.join(least, ["w0", "w1"]).where("rank_id > least").groupBy("unit").agg(F.collect_list("place").alias("places"))
    removed = cut(_cut_out(suspects.join(hits, "unit"), window))

    alike = copies.select("row_key", "unit_key", "unit_id")
    whole = F.col("unit_id").isNotNull() & (F.col("rank_id") > F.col("unit_id"))
    rows = scanned.drop("anchors", "unit").join(alike, "row_key", "left")
    rows = rows.select("row_key", "doc_id", "n_words", "words_sha", whole.alias("whole"), F.coalesce("unit_key", "row_key").alias("unit_key"))
    joined = rows.join(removed.withColumnRenamed("row_key", "unit_key"), "unit_key", "left")
    all_words = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    partly = F.col("n_removed").isNotNull()
    return joined.select(
        "row_key", "doc_id", "n_words",
        F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(F.col("whole"), all_words).when(partly, F.col("spans")).otherwise(F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("spans"),
        F.when(~F.col("whole") & partly, F.col("kept_text")).alias("kept_text"),
        "words_sha",
    )


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, n_words, n_removed, kept_sha256."""
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    sha = F.when(F.col("n_removed") == 0, F.lower(F.hex("words_sha"))).when(F.col("kept_text").isNull(), nothing).otherwise(F.sha2(F.col("kept_text").cast("binary"), 256))
    return found.select("doc_id", "n_words", "n_removed", sha.alias("kept_sha256"))


def drop_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` without repeated passages.

    A text that loses words becomes its kept words joined by blanks, with n_chars (if there is such a column) to
    match; a document that loses every word goes; all others stay as they are, white space included.
    """
    key, kept = free_name("_row_key", docs), free_name("_kept_text", docs)
    found = cut(find_repeats(docs, window).where("n_removed > 0").select("row_key", F.col("kept_text").alias(kept)).distinct())
    # one join for both: an empty kept text takes its document away
    marked = docs.withColumn(key, row_key(docs["doc_id"], docs["text"].cast("string")))
    joined = marked.join(found.withColumn(kept, F.coalesce(kept, F.lit(""))).withColumnRenamed("row_key", key), key, "left")
    changed = joined.where(F.col(kept).isNull() | (F.col(kept) != ""))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.coalesce(kept, "text").alias("text"))
        elif c == "n_chars":
            size = F.char_length(kept).cast(docs.schema["n_chars"].dataType)
            columns.append(F.when(F.col(kept).isNotNull(), size).otherwise(F.col("n_chars")).alias("n_chars"))
        else:
            columns.append(F.col(f"`{c}`"))
    return changed.select(*columns)
