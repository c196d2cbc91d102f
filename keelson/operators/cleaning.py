"""Row-level repairs and filters, and the rules that look at the message before or after."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.config import Config
from keelson.functions.clock import seconds_of
from keelson.functions.geo import haversine
from keelson.functions.ordered import CHUNK, with_chunk, with_neighbours
from keelson.functions.storage import cut
from keelson.sources.dims import status_codes

# Repair offsets, the unknown-heading code and the valid country digits.
UNKNOWN_HEADING = 511
SOG_WRAP = 102.6
COG_WRAP = 409.6
FIRST_COUNTRY = 201
LAST_COUNTRY = 775
UNNEEDED_COLUMNS = ("vessel_type", "status", "length", "width", "draft", "cargo", "transceiver_class")

ORDER = ("base_datetime", "event_id")


def parse_time(df: DataFrame, column: str = "base_datetime") -> DataFrame:
    """ISO text or timestamp to whole unix seconds (bigint)."""
    return df.withColumn(column, seconds_of(F.col(column).cast("timestamp_ntz")))


def null_unknown_heading(df: DataFrame) -> DataFrame:
    return df.withColumn("heading", F.nullif(F.col("heading"), F.lit(float(UNKNOWN_HEADING))))


def repair_negatives(df: DataFrame) -> DataFrame:
    """Undo the wrap-around of negative speeds and courses."""
    sog, cog = F.col("sog"), F.col("cog")
    return df.withColumns(
        {
            "sog": F.when(sog < 0, sog + SOG_WRAP).otherwise(sog),
            "cog": F.when(cog < 0, cog + COG_WRAP).otherwise(cog),
        }
    )


def valid_mmsi() -> F.Column:
    country = F.expr("try_cast(substring(mmsi, 1, 3) AS int)")
    return F.coalesce((F.length("mmsi") == 9) & country.between(FIRST_COUNTRY, LAST_COUNTRY), F.lit(False))


def filter_valid_mmsi(df: DataFrame) -> DataFrame:
    """Nine characters, the first three a country number."""
    return df.where(valid_mmsi())


def assign_vessel_group(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add ``vessel_group`` text; a code the table does not list keeps its own text.

    The table has about a hundred rows whatever the data, so it is broadcast.
    """
    code = F.coalesce(F.col("vessel_type").cast("int"), F.lit(-1)).cast("string")
    named = dim.withColumnRenamed("vessel_group", "_group")
    return (
        df.withColumn("type_text", code)
        .join(F.broadcast(named), "type_text", "left")
        .withColumn("vessel_group", F.coalesce("_group", "type_text"))
        .drop("_group", "type_text")
    )


def filter_vessel_groups(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    return df.where(F.col("vessel_group").isin(*groups))


def assign_status(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add ``status_code``: null text is -1, known text its code, number text that number.

    Any other text gets no code, so the status filter drops it.
    """
    text = F.coalesce(F.lower("status"), F.lit("-1"))
    return (
        df.withColumn("status_text", text)
        .join(F.broadcast(dim.withColumnRenamed("status_code", "_code")), "status_text", "left")
        .withColumn("status_code", F.coalesce(F.col("_code"), F.expr("try_cast(status_text AS int)")))
        .drop("_code", "status_text")
    )


def filter_statuses(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the codes of the named statuses; descriptions sharing a code are kept together."""
    return df.where(F.col("status_code").isin(*status_codes(names)))


def drop_unneeded(df: DataFrame) -> DataFrame:
    return df.drop(*UNNEEDED_COLUMNS)


def flag_stationary(df: DataFrame, cfg: Config) -> DataFrame:
    """Add ``stationary``: same position as the ship's previous message of the same track."""
    seen = with_neighbours(with_chunk(df, hot_rows=cfg.hot_rows), ["mmsi"], ORDER, ["base_datetime", "lat", "lon"], ["prev"])
    before = F.col("_prev")
    starts = before.isNull() | (F.col("base_datetime") - before["base_datetime"] > cfg.track_gap)
    moved = F.abs(F.col("lat") - before["lat"]) + F.abs(F.col("lon") - before["lon"]) != 0
    return seen.withColumn("stationary", ~(starts | F.coalesce(moved, F.lit(False)))).drop("_prev")


def drop_stationary(df: DataFrame, cfg: Config) -> DataFrame:
    """Drop messages at the position of the message before, unless they start a track."""
    return flag_stationary(df, cfg).where(~F.col("stationary")).drop("stationary")


def valid_sog(cutoff: float) -> F.Column:
    return F.coalesce(F.col("sog") <= cutoff, F.lit(False))


def valid_heading() -> F.Column:
    return F.col("heading").isNull() | F.col("heading").between(0, 360)


def valid_cog() -> F.Column:
    return F.coalesce(F.col("cog").between(0, 360), F.lit(False))


def filter_sog(df: DataFrame, cutoff: float) -> DataFrame:
    return df.where(valid_sog(cutoff))


def filter_heading(df: DataFrame) -> DataFrame:
    return df.where(valid_heading())


def filter_cog(df: DataFrame) -> DataFrame:
    return df.where(valid_cog())


def _knots(here: str, there: F.Column, forward: bool) -> F.Column:
    """Speed between a row and its neighbour: +inf when it moved in no time, null when it did not."""
    nm = haversine(F.col(f"{here}lat"), F.col(f"{here}lon"), there["lat"], there["lon"], "nm")
    seconds = there["base_datetime"] - F.col(f"{here}base_datetime")
    hours = (seconds if forward else -seconds) / 3600.0
    return (
        F.when(hours != 0, nm / hours)
        .when(nm > 0, F.lit(float("inf")))
        .otherwise(F.lit(None).cast("double"))
    )


def with_empirical_speed(df: DataFrame, cfg: Config) -> DataFrame:
    """Add ``prev_knots``, ``next_knots`` and whether the row is ``first``/``last`` of a track."""
    near = with_neighbours(with_chunk(df, hot_rows=cfg.hot_rows), ["mmsi"], ORDER, ["base_datetime", "lat", "lon"])
    prev, nxt, now = F.col("_prev"), F.col("_next"), F.col("base_datetime")
    return near.withColumns(
        {
            "prev_knots": F.when(prev.isNotNull(), _knots("", prev, False)),
            "next_knots": F.when(nxt.isNotNull(), _knots("", nxt, True)),
            "is_first": prev.isNull() | (now - prev["base_datetime"] > cfg.track_gap),
            "is_last": nxt.isNull() | (nxt["base_datetime"] - now > cfg.track_gap),
        }
    ).drop("_prev", "_next")


def flag_speed_outliers(df: DataFrame, cfg: Config, complete: bool = True) -> DataFrame:
    """Add ``outlier``: implausibly fast on both sides, or hardly moving inside a track.

    With complete trajectories a track end counts as a fast side; with partial ones it does
    not, because the message beyond it may lie in another file.
    """
    fast_in = F.coalesce(F.col("prev_knots") > cfg.speed_cutoff, F.lit(False))
    fast_out = F.coalesce(F.col("next_knots") > cfg.speed_cutoff, F.lit(False))
    slow = F.coalesce(F.col("prev_knots") < cfg.slow_speed, F.lit(False))
    inner = ~(F.col("is_first") | F.col("is_last"))
    if complete:
        fast_in, fast_out = fast_in | F.col("is_first"), fast_out | F.col("is_last")
    outlier = (fast_in & fast_out) | (slow & inner)
    return with_empirical_speed(df, cfg).withColumn("outlier", outlier)


def speed_outlier_pass(df: DataFrame, cfg: Config, complete: bool = True) -> DataFrame:
    """One pass: drop the rows flagged as speed outliers."""
    kept = flag_speed_outliers(df, cfg, complete).where(~F.col("outlier"))
    return kept.drop("outlier", "prev_knots", "next_knots", "is_first", "is_last")


def speed_outlier_keys(df: DataFrame, cfg: Config, complete: bool = True) -> DataFrame:
    """(mmsi, event_id) of every row the repeated pass drops.

    A drop gives its neighbours new neighbours, so passes repeat until one drops nothing.
    Vessels are independent: a later pass looks only at vessels that lost a row in the one
    before.  The loop carries positions and keys only, and each pass's drops are
    written out, so a lost executor costs one pass, not the history.
    """
    rest = with_chunk(df, hot_rows=cfg.hot_rows).select("mmsi", "event_id", "base_datetime", "lat", "lon", CHUNK)
    dropped = None
    while True:  # each pass drops a row at least, or ends
        flagged = flag_speed_outliers(rest, cfg, complete)
        gone = cut(flagged.where("outlier").select("mmsi", "event_id"))
        dropped = gone if dropped is None else dropped.unionByName(gone)
        if gone.isEmpty():
            return dropped
        rest = cut(
            rest.join(gone.select("mmsi").distinct(), "mmsi", "left_semi").join(
                gone, ["mmsi", "event_id"], "left_anti"
            )
        )


def speed_outliers(df: DataFrame, cfg: Config, complete: bool = True) -> DataFrame:
    """Drop speed outliers until none is left."""
    chunked = with_chunk(df, hot_rows=cfg.hot_rows)
    keys = speed_outlier_keys(chunked, cfg, complete)
    return chunked.join(keys, ["mmsi", "event_id"], "left_anti")


# Storage types of the joined table.
_NARROW = {"double": "float", "bigint": "int"}


def narrow_types(df: DataFrame) -> DataFrame:
    """Store wide numbers narrowly; times keep double, current columns become smallint."""
    types = {}
    for name, kind in df.dtypes:
        if name == "base_datetime":
            types[name] = "double"
        elif "water_u" in name or "water_v" in name:
            types[name] = "smallint"
        elif kind in _NARROW:
            types[name] = _NARROW[kind]
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})
