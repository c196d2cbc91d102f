"""Texts with the same words in the same order, found before any costlier comparison."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.storage import cut

#: Stands for a null id in comparisons: it comes after every other.
LAST_ID = 2**63 - 1


def words_digests(words: pa.Array, counts: np.ndarray) -> pa.Array:
    """SHA-256 of each text's words joined by one blank."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, words), " ")
    return pa.array([hashlib.sha256(x.as_buffer()).digest() for x in joined], pa.binary())


def word_copies(scanned: DataFrame) -> DataFrame:
    """The rows of ``scanned`` (row_key, rank_id, words_sha) that have an equal before them: row_key, unit_key, unit_id.

    Of rows with the same words, the one with the least id (then key) stands for all: the unit.  Hot groups are
    summed before they are shuffled, and the table of groups is written, so that the join on it can be split.
    """
    first = F.min(F.struct("rank_id", "row_key"))
    groups = cut(
        scanned.groupBy("words_sha").agg(F.count(F.lit(1)).alias("n"), first.alias("unit")).where("n > 1")
        .select("words_sha", F.col("unit.row_key").alias("unit_key"), F.col("unit.rank_id").alias("unit_id"))
    )
    return scanned.select("row_key", "words_sha").join(groups, "words_sha").where("row_key <> unit_key").select("row_key", "unit_key", "unit_id").distinct()
