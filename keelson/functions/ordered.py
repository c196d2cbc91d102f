"""Row order inside a key, without ever putting a whole key in one task.

A window over ``partitionBy(ship)`` sends all rows of a ship to one task, and one ship may
hold a third of the table.  Here each key is cut into chunks by a monotone function of the
row order.  Windows run inside (key, chunk); what crosses a chunk edge (the row before, the
row after, running counts) is computed on one summary row per chunk and joined back on
(key, chunk).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.clock import DAY, day_of

CHUNK = "_chunk"
_DAY_SHIFT = 1 << 40
_SECOND_SHIFT = 1 << 23
_TIE_SPAN = 1 << 20


def with_chunk(
    df: DataFrame,
    keys: Sequence[str] = ("mmsi",),
    time: str = "base_datetime",
    tie: str = "event_id",
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Add ``_chunk``: one value per key and day, or finer where a day is crowded.

    Days holding more than ``hot_rows`` rows of one key are cut by second and then by
    ``tie``, so neither a busy key nor a pile of copies sharing one second makes a big
    group.  The list of crowded days has at most rows/hot_rows entries, so broadcasting it
    is safe.  ``_chunk`` never decreases along (time, tie).
    """
    if CHUNK in df.columns:
        return df
    crowded = (
        df.groupBy(*keys, day_of(F.col(time)).alias("_day"))
        .count()
        .where(F.col("count") > hot_rows)
        .select(*keys, "_day", F.lit(True).alias("_crowded"))
    )
    tie_part = F.least(
        F.greatest(F.floor(F.col(tie) / _TIE_SPAN).cast("bigint"), F.lit(0)), F.lit(_SECOND_SHIFT - 1)
    )
    fine = F.pmod(F.col(time), F.lit(DAY)) * _SECOND_SHIFT + tie_part
    return (
        df.withColumn("_day", day_of(F.col(time)))
        .join(F.broadcast(crowded), [*keys, "_day"], "left")
        .withColumn(CHUNK, F.col("_day") * _DAY_SHIFT + F.when(F.col("_crowded"), fine).otherwise(F.lit(0)))
        .drop("_day", "_crowded")
    )


def by_chunk(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows dealt out by (key, chunk): the one exchange that row windows and chunk summaries share.

    Rows without a key or time, which no join on (key, chunk) would meet, are left out here, so that both readers of
    the exchange ask for the same filter.
    """
    there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, CHUNK)])
    return df.where(there).repartition(*keys, CHUNK)


def chunk_summaries(dealt: DataFrame, keys: Sequence[str], *summaries: Column) -> DataFrame:
    """One row per (key, chunk) of :func:`by_chunk` rows with some aggregates.

    The aggregate reads every column of the row, if only to keep one row whole.  Its input is then the very exchange
    that the row windows read, which Spark computes once; a narrower input would be a second one, with all that is
    before it computed again.
    """
    kept = F.any_value(F.struct(*[F.col(f"`{c}`") for c in dealt.columns])).alias("_kept")
    out = dealt.groupBy(*keys, CHUNK).agg(*summaries, kept)
    return out.where(F.col("_kept").isNotNull()).drop("_kept")


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    want: Sequence[str] = ("prev", "next"),
) -> DataFrame:
    """Add struct columns of ``columns`` from other rows of the same key.

    ``want`` names them: prev and next (the adjacent rows, null at the ends of the key),
    head and tail (the first and last row of the key).  ``df`` needs ``_chunk``.
    """
    row = F.struct(*columns)
    rank = F.struct(*order)
    dealt = by_chunk(df, keys)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    local = {"prev": F.lag(row).over(inside), "next": F.lead(row).over(inside)}
    edge_aggregates = []
    if {"next", "head"} & set(want):
        edge_aggregates.append(F.min_by(row, rank).alias("_first"))
    if {"prev", "tail"} & set(want):
        edge_aggregates.append(F.max_by(row, rank).alias("_last"))
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = {
        "prev": lambda: F.lag("_last").over(across),
        "next": lambda: F.lead("_first").over(across),
        "head": lambda: F.first("_first").over(whole),
        "tail": lambda: F.last("_last").over(whole),
    }
    edges = chunk_summaries(dealt, keys, *edge_aggregates).select(*keys, CHUNK, *[edge[w]().alias(f"_edge_{w}") for w in want])
    near = [w for w in want if w in local]
    out = dealt.withColumns({f"_near_{w}": local[w] for w in near}).join(edges, [*keys, CHUNK])
    return out.withColumns(
        {f"_{w}": F.coalesce(f"_near_{w}", f"_edge_{w}") if w in local else F.col(f"_edge_{w}") for w in want}
    ).drop(*[f"_near_{w}" for w in near], *[f"_edge_{w}" for w in want])


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``row_index`` (0-based) and ``row_count`` of each row inside its key."""
    dealt = by_chunk(df, keys)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = chunk_summaries(dealt, keys, F.count(F.lit(1)).alias("_n")).select(
        *keys,
        CHUNK,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
        F.sum("_n").over(whole).alias("row_count"),
    )
    return (
        dealt.withColumn("_at", F.row_number().over(inside))
        .join(sizes, [*keys, CHUNK])
        .withColumn("row_index", F.col("_base") + F.col("_at") - 1)
        .drop("_base", "_at")
    )


def rank_in_buckets(df: DataFrame, bucket: Column, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Exact overall rank from 1 (``rank``) and total (``total``), per ``by`` group.

    ``bucket`` must be monotone in the order and take a bounded number of values: rows are
    numbered inside their bucket, and only the table of bucket sizes, one row per bucket,
    is accumulated in one place.
    """
    rows = df.withColumn("_bucket", bucket)
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    sizes = (
        rows.groupBy(*by, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *by,
            "_bucket",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"),
            F.sum("_n").over(everything).alias("total"),
        )
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    return (
        rows.withColumn("_at", F.row_number().over(inside))
        .join(sizes, [*by, "_bucket"])
        .withColumn("rank", F.col("_base") + F.col("_at"))
        .drop("_bucket", "_at", "_base")
    )


def shuffled_rank(df: DataFrame, seed: str, key: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rank rows by a seeded digest of ``key``: a repeatable random order.

    The digest's first four hex digits make 65,536 even buckets.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")).cast("binary"))
    rows = df.withColumn("_digest", digest)
    ranked = rank_in_buckets(rows, F.substring("_digest", 1, 4), [F.col("_digest"), key], by)
    return ranked.drop("_digest")
