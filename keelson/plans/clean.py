"""The cleaning stages put together: per period, per ship, per dataset, and their audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.config import Config
from keelson.functions.ordered import CHUNK
from keelson.functions.storage import cut
from keelson.operators import cleaning, tracks
from keelson.sources.dims import status_codes


def _usable(df: DataFrame, cfg: Config) -> DataFrame:
    """Valid speed, heading and course."""
    return cleaning.filter_cog(cleaning.filter_heading(cleaning.filter_sog(df, cfg.sog_cutoff)))


def attribute_rules(df: DataFrame, cfg: Config, vessel_dim: DataFrame, status_dim: DataFrame) -> DataFrame:
    """Every repair and filter that needs one row only; all of it runs inside the scan stage."""
    repaired = cleaning.repair_negatives(cleaning.null_unknown_heading(df))
    vessels = cleaning.filter_valid_mmsi(repaired)
    grouped = cleaning.filter_vessel_groups(cleaning.assign_vessel_group(vessels, vessel_dim), cfg.vessel_groups)
    moving = cleaning.filter_statuses(cleaning.assign_status(grouped, status_dim), cfg.statuses)
    return cleaning.drop_unneeded(moving).drop("status_code")


def clean_tracks(df: DataFrame, cfg: Config) -> DataFrame:
    """Full rules on complete trajectories: stationary, ranges, speed, tracks, minimum length.

    The rows left after the range rules are read by every later step, so they are stored.
    """
    moving = cut(_usable(cleaning.drop_stationary(df, cfg), cfg))
    steady = cleaning.speed_outliers(moving, cfg)
    return tracks.filter_short_tracks(tracks.assign_tracks(steady, cfg), cfg)


def _per_group(df: DataFrame, group: str) -> DataFrame:
    """Make vessels of different groups different vessels; undone by :func:`_as_before`."""
    return df.withColumn("_ship", F.col("mmsi")).withColumn(
        "mmsi", F.concat_ws("/", F.col(group).cast("string"), F.col("mmsi"))
    )


def _as_before(df: DataFrame) -> DataFrame:
    return df.withColumn("mmsi", F.col("_ship")).drop("_ship")


def clean_period(df: DataFrame, cfg: Config, vessel_dim: DataFrame, status_dim: DataFrame) -> DataFrame:
    """First pass, period by period: drop what no later pass could want.

    ``df`` carries ``period``, ``min_time`` and ``max_time``.  A trajectory may continue in
    the next period, so a track end excuses a message from the speed rule and tracks near
    the bounds are kept whatever their length.
    """
    rows = _per_group(attribute_rules(df, cfg, vessel_dim, status_dim), "period")
    moving = cut(_usable(cleaning.drop_stationary(rows, cfg), cfg))
    steady = _as_before(cleaning.speed_outliers(moving, cfg, complete=False))
    tracked = tracks.assign_tracks(steady, cfg, ("period", "mmsi"))
    kept = tracks.filter_short_tracks_in_period(tracked, cfg)
    return kept.drop("track", "min_time", "max_time", CHUNK)


def clean(
    df: DataFrame, cfg: Config, vessel_dim: DataFrame, status_dim: DataFrame, is_test: Column | None = None
) -> DataFrame:
    """Raw messages with periods to cleaned tracks with ``split`` train, valid or test.

    Periods are split by time first, so no trajectory spans train and test; ``is_test``
    overrides the default of the last share of the months in ``cfg.years``.
    """
    first = cut(clean_period(df, cfg, vessel_dim, status_dim))
    if is_test is None:
        is_test = tracks.split_by_month(
            F.col("base_datetime"), (min(cfg.years), 1), 12 * len(cfg.years), cfg.test_fraction
        ) == F.lit("test")
    rows = _per_group(first.withColumn("_test", is_test), "_test")
    moving = cut(_usable(cleaning.drop_stationary(rows, cfg), cfg))
    steady = _as_before(cleaning.speed_outliers(moving, cfg))
    tracked = cut(tracks.assign_tracks(steady, cfg, ("_test", "mmsi")))
    spans = tracks.track_lengths(tracked, ("_test", "track"))
    long = spans.where(F.col("track_end") - F.col("track_start") > cfg.min_track)
    kept = tracked.join(long.select("_test", "track"), ["_test", "track"], "left_semi")
    rest = tracks.track_split(kept.where(~F.col("_test")), cfg.validation_fraction, cfg.seed)
    test = kept.where("_test").withColumn("split", F.lit("test"))
    return rest.unionByName(test).drop("_test", "period", CHUNK)


def clean_audit(df: DataFrame, cfg: Config, vessel_dim: DataFrame, status_dim: DataFrame) -> DataFrame:
    """(step, reason, dropped, remaining, percent): what each rule drops of what reached it.

    One-row rules are counted in a single aggregate over the messages, the later ones in
    one aggregate per stage.
    """
    repaired = cleaning.repair_negatives(cleaning.null_unknown_heading(df))
    graded = cleaning.assign_status(cleaning.assign_vessel_group(repaired, vessel_dim), status_dim)
    ship = cleaning.valid_mmsi()
    group = F.col("vessel_group").isin(*cfg.vessel_groups)
    status = F.coalesce(F.col("status_code").isin(*status_codes(cfg.statuses)), F.lit(False))

    attributes = graded.agg(
        F.count(F.lit(1)).alias("n0"),
        F.count_if(ship).alias("n1"),
        F.count_if(ship & group).alias("n2"),
        F.count_if(ship & group & status).alias("n3"),
    )
    flagged = cut(cleaning.flag_stationary(attribute_rules(df, cfg, vessel_dim, status_dim), cfg))
    usable = cleaning.valid_sog(cfg.sog_cutoff) & cleaning.valid_heading() & cleaning.valid_cog()
    moves = ~F.col("stationary")
    positions = flagged.agg(F.count_if(moves).alias("n4"), F.count_if(moves & usable).alias("n5"))
    steady = cleaning.speed_outliers(flagged.where(moves & usable).drop("stationary"), cfg)
    tracked = tracks.assign_tracks(steady, cfg)
    spans = tracked.groupBy("track").agg(
        F.count(F.lit(1)).alias("n"),
        (F.max("base_datetime") - F.min("base_datetime") > cfg.min_track).alias("long"),
    )
    lengths = spans.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n6"), F.coalesce(F.sum(F.when(F.col("long"), F.col("n"))), F.lit(0)).alias("n7")
    )
    counts = reduce(lambda a, b: a.join(F.broadcast(b), F.lit(True)), [positions, lengths], attributes)
    reasons = ["invalid mmsi", "vessel type", "status", "stationary", "sog cog heading", "empirical speed", "short track"]
    steps = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(reason).alias("reason"),
                (F.col(f"n{i}") - F.col(f"n{i + 1}")).alias("dropped"),
                F.col(f"n{i + 1}").alias("remaining"),
                F.try_divide((F.col(f"n{i}") - F.col(f"n{i + 1}")) * 100.0, F.col(f"n{i}")).alias("percent"),
            )
            for i, reason in enumerate(reasons)
        ]
    )
    return counts.select(F.inline(steps))
