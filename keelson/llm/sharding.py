"""Sharding by balanced label propagation: linked documents together, shards of one size.

Documents with the same link value (by default: equal texts) are neighbours.  Every document starts in the shard its
hash names.  The documents of a neighbourhood that start in the same shard move as one *cell*, so a round costs by
cells and not by documents or pairs: Spark joins every cell with the shard that holds most of its neighbours and still
has room, and the cells that would come to a larger holding wish to move there.  Quotas then scale the wishes, shard
by shard, until no shard gets more than its capacity, what leaves it counted; a cell goes if its hash falls within its
quota.  Cells only ever move to larger holdings, so the rounds come to rest; they end when no wish is granted.

A neighbourhood too large for half a shard is cut by hash into ones that fit, as it must be divided in any case.
Documents without a neighbour have no wish; they fill what the linked ones leave free, and so do the few linked
documents by which a shard ended over its capacity (quotas are met by shares, not counts).  All places follow from
exact ranks in buckets, so shards differ by one row at most, whatever the texts.

A null text counts as an empty one, and those are neighbours too; repeated rows are documents of their own; null ids
are allowed; extra columns are not looked at; an empty table gives an empty result; more shards than documents leave
shards empty.  Which of several equally good places a document gets depends on how the table is divided into tasks.
The driver sees one number per shard and per pair of shards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.storage import cut

#: Rows to a bucket in which ranks are taken, as long as that gives no more than _BUCKETS.
_BUCKET_ROWS = 2048
_BUCKETS = 65_536


def capacities(n_rows: int, n_shards: int) -> np.ndarray:
    return n_rows // n_shards + (np.arange(n_shards) < n_rows % n_shards)


def quotas(wishes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """What share of the wishes from shard (row) to shard (column) can be granted, so that none overflows.

    A shard takes what it has room for and what leaves it.  Cutting the wishes into a full shard also leaves less
    leaving elsewhere, hence the repetition; shares only fall, so it ends.
    """
    granted = wishes.astype(float)
    for _ in range(200):
        coming = granted.sum(0)
        allowed = np.maximum(room + granted.sum(1), 0)
        share = np.where(coming > allowed, allowed / np.maximum(coming, 1e-9), 1.0)
        if (share > 1 - 1e-6).all():
            break
        granted = granted * share
    return np.divide(granted, wishes, out=np.zeros_like(granted), where=wishes > 0)


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) that hangs on the values alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _numbers(rows, size: int) -> np.ndarray:
    out = np.zeros(size)
    for r in rows:
        out[r[0]] = r[1]
    return out


def propagate(cells: DataFrame, capacity: np.ndarray, rounds: int = 12) -> DataFrame:
    """``cells`` (community, home, n) with the shard each comes to, after at most ``rounds`` rounds."""
    spark = cells.sparkSession
    n_shards = len(capacity)
    cells = cut(cells.withColumn("shard", F.col("home")))
    for turn in range(rounds):
        loads = _numbers(cells.groupBy("shard").agg(F.sum("n")).collect(), n_shards)
        room = capacity - loads
        vacant = [int(s) for s in np.flatnonzero(room > 0)]
        held = cells.repartition("community").groupBy("community", "shard").agg(F.sum("n").alias("held"))
        held = held.withColumn("rank", F.struct("held", F.xxhash64("community", "shard").alias("tie"), "shard"))
        # a shard without room is still a neighbour's place when others leave it: only its own cells may stay there
        best = held.where(F.col("shard").isin(vacant)).groupBy("community").agg(F.max("rank").alias("best"))
        wishes = cut(held.join(best, "community").where("rank < best").select("community", "shard", "held", F.col("best.shard").alias("target")))
        wished = np.zeros((n_shards, n_shards))
        for r in wishes.groupBy("shard", "target").agg(F.sum("held").alias("n")).collect():  # n_shards ** 2 rows at most
            wished[r["shard"], r["target"]] = r["n"]
        share = quotas(wished, room)
        if not (share * wished).sum() >= 1:
            break
        granted = spark.createDataFrame([(int(s), int(t), float(share[s, t])) for s, t in zip(*np.nonzero(share))], "shard int, target int, share double")
        going = wishes.join(F.broadcast(granted), ["shard", "target"]).where(_unit(F.col("community"), F.col("shard"), F.lit(turn)) < F.col("share"))
        moved = cells.join(going.select("community", "shard", "target"), ["community", "shard"], "left")
        cells = cut(moved.select("community", "home", "n", F.coalesce("target", "shard").alias("shard")))
    return cells


def shard(docs: DataFrame, n_shards: int = 40, link: Column | None = None, rounds: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, community (null: no neighbour), shard, slot.

    ``link`` gives the value that neighbours share, null for none; left out, it is the text.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = cut(
        docs.select(
            F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5((text if link is None else link.cast("string")).cast("binary"))).alias("link"),
        )
    )
    total = base.count()
    capacity = capacities(total, n_shards)
    linked = base.where("link is not null").groupBy("link").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    parts = F.ceil(F.col("members") * 2 / F.lit(max(1, total // n_shards))).cast("long")
    community = F.when(F.col("members").isNotNull(), F.xxhash64("link", F.pmod(F.xxhash64("row"), parts)))
    home = F.pmod(F.xxhash64("row", F.lit("home")), F.lit(n_shards)).cast("int")
    tagged = cut(base.join(cut(linked), "link", "left").select("row", "doc_id", "size", "text_crc32", community.alias("community"), home.alias("home")))
    cells = propagate(tagged.where("community is not null").groupBy("community", "home").agg(F.count(F.lit(1)).alias("n")), capacity, rounds)

    settled = tagged.where("community is not null").join(cells.select("community", "home", F.col("shard").alias("lane")), ["community", "home"])
    free = tagged.where("community is null").withColumn("lane", F.lit(n_shards))  # one lane more, for those without a wish
    n_buckets = min(_BUCKETS, total // _BUCKET_ROWS + 1)
    bucket = F.pmod(F.xxhash64("row", F.lit("bucket")), F.lit(n_buckets)).cast("int")
    laid = cut(settled.unionByName(free).drop("home").withColumn("bucket", bucket))
    counts = cut(laid.groupBy("lane", "bucket").agg(F.count(F.lit(1)).alias("here")))
    before = Window.partitionBy("lane").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("lane", "bucket", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("lane", "bucket").orderBy("row")) - 1
    ranked = laid.withColumn("nth", nth).join(cut(starts), ["lane", "bucket"]).withColumn("rank", F.col("before") + F.col("nth"))

    loads = _numbers(counts.groupBy("lane").agg(F.sum("here")).collect(), n_shards + 1).astype(np.int64)
    stay = np.minimum(loads[:-1], capacity)
    over = loads[:-1] - stay  # the last of each shard, by rank, join those without a wish
    lane_over = loads[-1] + np.cumsum(over) - over
    lane_stay = np.append(stay, 0)
    lane_start = np.append(lane_over, 0)
    openings = np.cumsum(capacity - stay)  # places left free up to and with each shard

    def number(values: np.ndarray, at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(int(v)) for v in values]).cast("array<bigint>"), (at + 1).cast("int"))

    stays = F.col("rank") < number(lane_stay, F.col("lane"))
    filler = number(lane_start, F.col("lane")) + F.col("rank") - number(lane_stay, F.col("lane"))
    ends = F.array(*[F.lit(int(v)) for v in openings]).cast("array<bigint>")
    placed = ranked.withColumn("filler", F.when(~stays, filler)).withColumn("to", F.when(stays, F.col("lane")).otherwise(F.size(F.filter(ends, lambda e: e <= F.col("filler")))))
    first = number(openings - (capacity - stay), F.col("to"))
    slot = F.when(stays, F.col("rank")).otherwise(number(stay, F.col("to")) + F.col("filler") - first)
    return placed.select("doc_id", "size", "text_crc32", "community", F.col("to").cast("int").alias("shard"), slot.cast("long").alias("slot"))


def query_rows(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """The rows of :func:`shard` under the law ``rows``: counts at most one apart."""
    return shard(docs, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
