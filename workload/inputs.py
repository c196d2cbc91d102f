"""Ship messages and ocean currents derived from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.config import Box, Config
from keelson.functions.clock import seconds_of
from keelson.functions.storage import cut
from keelson.operators import cleaning, resample, tracks
from keelson.sources.dims import status_dim, vessel_dim

CFG = Config(
    track_gap=43_200,
    step=3_600,
    history=5,
    future=3,
    min_track=28_800,
    time_gaps=(3_600, 7_200),
    window_movement=7_200,
    seed="7",
    years=(2024,),
)
BOX = Box(26.0, 29.0, -85.5, -81.5)
INNER_BOX = Box(26.5, 28.5, -85.0, -82.0)
EPS_KM = 20.0
MIN_PTS = 5
CLUSTER_RUNS = ((10.0, 4), (20.0, 5), (30.0, 10))

# One row per event, placed on the map by ship and two-hour bucket.
MESSAGE_COLUMNS = """
  event_id,
  cast(case when user_id % 10 = 9 then 100000000 + user_id
            when user_id % 10 = 8 then 20100000 + user_id
            else 201000000 + user_id end as string) as mmsi,
  base_datetime,
  cast(26.0 as double) + cast((k * 37) % 3001 as double) / 1000 as lat,
  cast(-85.5 as double) + cast((k * 91) % 4001 as double) / 1000 as lon,
  case when event_id % 50 = 0 then value / 5 - 60 else value / 5 end as sog,
  cast((event_id * 53) % 4200 as double) / 10 - 20 as cog,
  cast(case when event_id % 11 = 0 then 511 else (event_id * 29) % 366 end as double) as heading,
  cast(case user_id % 8 when 0 then 70 when 1 then 60 when 2 then 30 when 3 then 31
                   when 4 then 80 when 5 then 36 when 6 then 1004 else 35 end as double) as vessel_type,
  case event_type when 'error' then 'Moored' when 'signup' then 'Under way sailing'
                  when 'purchase' then 'Under way using engine' else null end as status
"""
_NAMES = [
    "event_id", "mmsi", "base_datetime", "lat", "lon", "sog", "cog", "heading", "vessel_type", "status",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position messages with snake-case names and unix seconds."""
    events = table(spark, sf_dir, "events").withColumn("base_datetime", seconds_of(F.col("ts")))
    bucket = F.floor((F.col("base_datetime") - F.pmod("base_datetime", F.lit(7200))) / 7200)
    keyed = events.withColumn("k", F.col("user_id") * 1009 + bucket)
    columns = [c.strip() for c in _split_columns(MESSAGE_COLUMNS)]
    return keyed.selectExpr(*columns).select(*_NAMES)


def _split_columns(text: str) -> list[str]:
    """Top-level comma split of a select list."""
    parts, depth, start = [], 0, 0
    for at, char in enumerate(text):
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            parts.append(text[start:at])
            start = at + 1
    return [*parts, text[start:]]


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as the source publishes them: its column names, text times."""
    m = messages(spark, sf_dir)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("base_datetime") / 86400).cast("int"))
    second = F.pmod("base_datetime", F.lit(86400))
    text = F.concat(
        day.cast("string"),
        F.format_string(
            "T%02d:%02d:%02d",
            F.floor(second / 3600), F.floor(second % 3600 / 60), second % 60,
        ),
    )
    return m.select(
        F.col("mmsi").alias("MMSI"),
        text.alias("BaseDateTime"),
        F.col("lat").alias("LAT"),
        F.col("lon").alias("LON"),
        F.col("sog").alias("SOG"),
        F.col("cog").alias("COG"),
        F.col("heading").alias("Heading"),
        F.concat(F.lit("VESSEL "), "mmsi").alias("VesselName"),
        F.concat(F.lit("IMO"), "mmsi").alias("IMO"),
        F.concat(F.lit("C"), "mmsi").alias("CallSign"),
        F.col("vessel_type").alias("VesselType"),
        F.col("status").alias("Status"),
        (F.col("event_id") % 300).cast("double").alias("Length"),
        (F.col("event_id") % 40).cast("double").alias("Width"),
        (F.col("event_id") % 15).cast("double").alias("Draft"),
        (F.col("event_id") % 90).cast("double").alias("Cargo"),
        F.when(F.col("event_id") % 2 == 0, "A").otherwise("B").alias("TransceiverClass"),
        F.col("event_id"),
    )


def attribute_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages after every rule that looks at one row only, up to vessel type and status."""
    m = cleaning.repair_negatives(cleaning.null_unknown_heading(messages(spark, sf_dir)))
    m = cleaning.filter_valid_mmsi(m)
    m = cleaning.filter_vessel_groups(cleaning.assign_vessel_group(m, vessel_dim(spark)), CFG.vessel_groups)
    m = cleaning.filter_statuses(cleaning.assign_status(m, status_dim(spark)), CFG.statuses)
    return cleaning.drop_unneeded(m).drop("status_code")


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute-filtered messages with valid speed, course and heading, stationary ones dropped."""
    m = cleaning.drop_stationary(attribute_filtered(spark, sf_dir), CFG)
    return cleaning.filter_cog(cleaning.filter_heading(cleaning.filter_sog(m, CFG.sog_cutoff)))


def long_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid messages on tracks longer than the minimum: a stage output, so stored."""
    tracked = cut(tracks.assign_tracks(valid(spark, sf_dir), CFG))
    return cut(tracks.filter_short_tracks(tracked, CFG))


def split_tracks(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Long tracks (``rows`` if they are there) with a dataset each: the last third of days is test, the rest train/valid.

    The given tables span one month, so days stand in for months here.
    """
    rows = long_tracks(spark, sf_dir) if rows is None else rows
    start = F.min("base_datetime")
    first = rows.groupBy("track").agg(start.alias("_start"))
    test = F.col("_start") >= SPLIT_SECOND
    tagged = rows.join(first, "track").withColumn("_test", test).drop("_start")
    train_valid = tracks.track_split(tagged.where(~F.col("_test")).drop("_test"), CFG.validation_fraction, CFG.seed)
    return train_valid.unionByName(tagged.where("_test").drop("_test").withColumn("split", F.lit("test")))


def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split tracks on the hourly grid."""
    return resample.interpolate_tracks(split_tracks(spark, sf_dir), CFG)


SPLIT_SECOND = 1_705_708_800  # 2024-01-20 00:00 UTC
EPOCH = 1_704_067_200  # 2024-01-01 00:00 UTC


def current_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Currents on a 24 x 24 grid at 40 three-hourly stamps, summed up from the line items."""
    cells = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            (F.col("l_partkey") % 24).alias("i"),
            (F.col("l_suppkey") % 24).alias("j"),
            (F.col("l_orderkey") % 40).alias("t"),
        )
        .agg(
            F.sum(F.expr("l_partkey * 31 + l_suppkey * 17 + l_orderkey * 13 + l_linenumber * 7")).alias("a"),
            F.sum(F.expr("l_partkey * 7 + l_suppkey * 43 + l_orderkey * 29 + l_linenumber * 11")).alias("b"),
        )
    )
    hidden = ((F.col("i") + F.col("j")) % 9 == 0) | ((F.col("i") * F.col("j") % 7 == 3) & (F.col("t") % 3 != 0))

    def speed(name):
        return F.when(~hidden, (F.col(name) % 401 - 200) / F.lit(1000.0))

    return cells.select(
        ((F.col("i") * 13 + 2590) / F.lit(100.0)).alias("latitude"),
        ((F.col("j") * 18 - 8558) / F.lit(100.0)).alias("longitude"),
        (F.col("t") * 10800 + EPOCH).alias("time"),
        speed("a").alias("water_u"),
        speed("b").alias("water_v"),
    )


def current_long(spark: SparkSession, sf_dir: str, variable: str) -> DataFrame:
    """One variable as the currents source delivers it: cell, speed, calendar stamp."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("time") / 86400).cast("int"))
    return current_cells(spark, sf_dir).select(
        "latitude",
        "longitude",
        F.col(variable).alias("speed"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.floor(F.pmod("time", F.lit(86400)) / 3600).cast("int").alias("hour"),
    )
