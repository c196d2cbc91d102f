"""Cutting a ship's messages into tracks; keeping long ones; splitting into datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.config import Config
from keelson.functions.clock import month_of, year_of
from keelson.functions.ordered import CHUNK, by_chunk, chunk_summaries, shuffled_rank, with_chunk

# Fixed value: track = mmsi * this + number of the track within its ship, from 1.
TRACKS_PER_SHIP = 1_000_000


def assign_tracks(df: DataFrame, cfg: Config, keys: Sequence[str] = ("mmsi",)) -> DataFrame:
    """Add ``track``: a new one when the ship changes or is silent for more than the gap.

    Counting runs inside (ship, chunk); the number of tracks begun in earlier chunks comes
    from a summary row per chunk, so a very busy ship is never one task.
    """
    rows = by_chunk(with_chunk(df, keys, hot_rows=cfg.hot_rows), keys)
    inside = Window.partitionBy(*keys, CHUNK).orderBy("base_datetime", "event_id")
    now = F.col("base_datetime")
    broken = rows.withColumn("_break", F.coalesce((now - F.lag(now).over(inside) > cfg.track_gap).cast("int"), F.lit(0)))
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    summary = (
        chunk_summaries(broken, keys, F.min(now).alias("_first"), F.max(now).alias("_last"), F.sum("_break").alias("_breaks"))
        .withColumn("_gap", F.col("_first") - F.lag("_last").over(across))
        .withColumn("_starts", (F.col("_gap").isNull() | (F.col("_gap") > cfg.track_gap)).cast("int"))
        .withColumn("_upto", F.sum(F.col("_starts") + F.col("_breaks")).over(across.rowsBetween(Window.unboundedPreceding, 0)))
        .select(*keys, CHUNK, (F.col("_upto") - F.col("_breaks")).alias("_base"))
    )
    number = (
        F.col("_base") + F.sum("_break").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    too_many = F.concat(F.lit("too many tracks for ship "), F.col("mmsi"))
    checked = F.when(F.col("_number") <= TRACKS_PER_SHIP, F.col("_number")).otherwise(
        F.raise_error(too_many).cast("bigint")
    )
    return (
        broken.join(summary, [*keys, CHUNK])
        .withColumn("_number", number)
        .withColumn("track", F.col("mmsi").cast("bigint") * TRACKS_PER_SHIP + checked)
        .drop("_break", "_base", "_number")
    )


def track_lengths(df: DataFrame, keys: Sequence[str] = ("track",)) -> DataFrame:
    """First and last second of every track; partial sums shrink the shuffle to one row per track and task."""
    return df.groupBy(*keys).agg(
        F.min("base_datetime").alias("track_start"), F.max("base_datetime").alias("track_end")
    )


def filter_short_tracks(df: DataFrame, cfg: Config) -> DataFrame:
    """Keep tracks lasting longer than the minimum."""
    long = track_lengths(df).where(F.col("track_end") - F.col("track_start") > cfg.min_track)
    return df.join(long.select("track"), "track", "left_semi")


def filter_short_tracks_in_period(df: DataFrame, cfg: Config) -> DataFrame:
    """Per period, also keep tracks that may continue in the period before or after.

    ``df`` carries ``period`` with its bounds ``min_time`` and ``max_time``.
    """
    keys = ["period", "track"]
    spans = df.groupBy(*keys).agg(
        F.min("base_datetime").alias("track_start"),
        F.max("base_datetime").alias("track_end"),
        F.first("min_time").alias("_from"),
        F.first("max_time").alias("_to"),
    )
    keep = spans.where(
        (F.col("track_end") - F.col("track_start") > cfg.min_track)
        | (F.col("track_start") - F.col("_from") <= cfg.track_gap)
        | (F.col("_to") - F.col("track_end") <= cfg.track_gap)
    )
    return df.join(keep.select(*keys), keys, "left_semi")


def test_months(months: int, fraction: float) -> int:
    """How many of the last months make the test set."""
    return int(months * fraction)


def split_by_month(seconds: Column, first_month: tuple[int, int], months: int, fraction: float) -> Column:
    """'test' for the last months of the range, 'train' before; no test month means all train."""
    index = (year_of(seconds) - first_month[0]) * 12 + month_of(seconds) - first_month[1]
    return F.when(index >= months - test_months(months, fraction), F.lit("test")).otherwise(F.lit("train"))


def temporal_split(df: DataFrame, years: Sequence[int], fraction: float) -> DataFrame:
    """Add ``split`` by calendar: the most recent share of the months of ``years`` is test."""
    return df.withColumn(
        "split", split_by_month(F.col("base_datetime"), (min(years), 1), 12 * len(years), fraction)
    )


def track_split(df: DataFrame, fraction: float, seed: str) -> DataFrame:
    """Add ``split``: a seeded random share of whole tracks becomes 'valid', the rest 'train'."""
    tracks = shuffled_rank(df.select("track").distinct(), seed, F.col("track"))
    chosen = tracks.select(
        "track",
        F.when(F.col("rank") <= F.floor(F.col("total") * fraction), "valid").otherwise("train").alias("split"),
    )
    return df.join(chosen, "track")
