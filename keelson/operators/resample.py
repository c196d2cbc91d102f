"""Resampling tracks onto a regular time grid, without a join against the grid.

Every message owns the grid times from its own time up to the next message of its track, so
it can generate them itself: only the next message and the track's first time are needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.config import Config
from keelson.functions.clock import month_of, year_of
from keelson.functions.ordered import CHUNK, with_chunk, with_neighbours

# How each column of the cleaned table is resampled.
INTERPOLATED = ("lat", "lon", "sog", "cog", "heading")
STABLE = ("mmsi", "vessel_group")
_HANDLED = {"track", "base_datetime", "event_id", CHUNK, "split", "period"}


def _grid_rows(df: DataFrame, step: int, columns: Sequence[str], first_of: Sequence[str], hot_rows: int) -> DataFrame:
    """Messages exploded to the grid steps they own; keeps the next row and the track's first row."""
    rows = with_chunk(df.drop(CHUNK), ["track"], hot_rows=hot_rows)
    carried = list(dict.fromkeys(["base_datetime", *columns, *first_of]))
    near = with_neighbours(rows, ["track"], ["base_datetime", "event_id"], carried, ["next", "head", "tail"])
    t0 = F.col("_head")["base_datetime"]
    here = F.col("base_datetime")
    # The last message owns its own second only.
    until = F.coalesce(F.col("_next")["base_datetime"], here + 1)
    first = F.ceil((here - t0) / step).cast("bigint")
    last = F.ceil((until - t0) / step).cast("bigint") - 1
    return (
        near.withColumn("row_index", F.explode(F.when(last >= first, F.sequence(first, last))))
        .withColumn("_t", t0 + F.col("row_index") * step)
        .withColumn(
            "row_count",
            F.floor((F.col("_tail")["base_datetime"] - t0) / step).cast("bigint") + 1,
        )
    )


def resample_grid(df: DataFrame, cfg: Config) -> DataFrame:
    """(track, base_datetime) of every grid time: first, first + step, ... up to the last."""
    spans = df.groupBy("track").agg(F.min("base_datetime").alias("_a"), F.max("base_datetime").alias("_b"))
    return spans.select("track", F.explode(F.sequence("_a", "_b", F.lit(cfg.step).cast("bigint"))).alias("base_datetime"))


def interpolate(
    df: DataFrame,
    cfg: Config,
    linear: Sequence[str] = INTERPOLATED,
    previous: Sequence[str] = (),
    stable: Sequence[str] = (),
    circular: Sequence[str] = (),
) -> DataFrame:
    """Values at every grid time of every track.

    ``linear`` columns are interpolated between the messages around the grid time and are
    null where a needed end is null; ``previous`` columns take the latest message's value;
    ``stable`` columns the track's first.  ``circular`` names angles to turn the short way.
    Adds year, month, and the row's position in its track (``row_index``, ``row_count``),
    from which sliding windows follow without another sort.
    """
    rows = _grid_rows(df, cfg.step, linear, stable, cfg.hot_rows)
    here, nxt = F.col("base_datetime"), F.col("_next")
    weight = F.when(
        F.col("_t") != here, (F.col("_t") - here) / (nxt["base_datetime"] - here)
    )

    def between(name):
        delta = nxt[name] - F.col(name)
        if name in circular:
            delta = F.pmod(delta + 180.0, F.lit(360.0)) - 180.0
            return F.when(weight.isNull(), F.col(name)).otherwise(F.pmod(F.col(name) + delta * weight, F.lit(360.0)))
        return F.when(weight.isNull(), F.col(name)).otherwise(F.col(name) + delta * weight)

    t = F.col("_t")
    return rows.select(
        "track",
        t.alias("base_datetime"),
        *[between(c).alias(c) for c in linear],
        *[F.col(c) for c in previous],
        *[F.col("_head")[c].alias(c) for c in stable],
        year_of(t).cast("smallint").alias("year"),
        month_of(t).cast("tinyint").alias("month"),
        "row_index",
        "row_count",
    )


def interpolate_tracks(df: DataFrame, cfg: Config) -> DataFrame:
    """Resample a cleaned table; a column with no stated treatment is an error."""
    keep = [c for c in ("split",) if c in df.columns]
    unknown = [c for c in df.columns if c not in {*INTERPOLATED, *STABLE, *_HANDLED}]
    if unknown:
        raise ValueError(f"no resampling rule for columns {unknown}")
    stable = [c for c in (*STABLE, *keep) if c in df.columns]
    return interpolate(df, cfg, [c for c in INTERPOLATED if c in df.columns], stable=stable)
