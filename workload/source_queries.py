"""Reading, landing, file calendar, lookups, stage outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.geo import utm_zone
from keelson.functions.storage import work_folder
from keelson.sources import catalogue, currents, messages, sinks
from keelson.sources.dims import status_dim, vessel_dim
from workload import inputs
from workload.inputs import INNER_BOX
from workload.cleaning_queries import RAW_TEXT
from workload.registry import big, cte, query

RAW_KEPT = f"""mmsi as "MMSI", {RAW_TEXT} as "BaseDateTime", lat as "LAT", lon as "LON", sog as "SOG", cog as "COG",
  heading as "Heading", vessel_type as "VesselType", status as "Status" """
RAW_ALL = RAW_KEPT + """, 'VESSEL ' || mmsi as "VesselName", 'IMO' || mmsi as "IMO", 'C' || mmsi as "CallSign",
  cast(event_id % 300 as double) as "Length", cast(event_id % 40 as double) as "Width",
  cast(event_id % 15 as double) as "Draft", cast(event_id % 90 as double) as "Cargo",
  case when event_id % 2 = 0 then 'A' else 'B' end as "TransceiverClass" """


@query("read_messages", f"select {RAW_ALL} from ais")
def _(spark, sf):
    raw = inputs.raw_messages(spark, sf).select(*messages.MESSAGE_SCHEMA.fieldNames())
    folder = work_folder(spark, "csv")
    raw.write.option("header", True).csv(folder)
    return messages.read_messages(spark, folder)


@query(
    "bbox_filter",
    f"""select event_id, lat, lon from ais where lat < {INNER_BOX.lat_2} and lat > {INNER_BOX.lat_1}
      and lon < {INNER_BOX.lon_2} and lon > {INNER_BOX.lon_1}""",
)
def _(spark, sf):
    return messages.bbox_filter(inputs.messages(spark, sf), INNER_BOX, "lat", "lon").select("event_id", "lat", "lon")


@query("drop_identity_sort_write", f"select event_id, {RAW_KEPT} from ais")
def _(spark, sf):
    landed = messages.land_messages(inputs.raw_messages(spark, sf), work_folder(spark, "landed"))
    return landed.drop("Length", "Width", "Draft", "Cargo", "TransceiverClass")


# The file calendar: every order stands for a file delivered by the source.
cte(
    "delivered",
    """select o_orderkey, cast(2015 + o_custkey % 7 as int) as year, cast(1 + o_orderkey % 12 as int) as month,
      cast(1 + o_orderkey % 28 as int) as day, cast(16 + o_custkey % 2 as int) as zone from orders""",
)
SPECIFIER = """printf('%d/AIS_%d_%02d_%s%02d.parquet', year, year, month,
  case when year <= 2017 then 'Zone' else '' end, case when year <= 2017 then zone else day end)"""
cte(
    "calendar",
    """select year, month, zone as zone_or_day, printf('%d/AIS_%d_%02d_Zone%02d.parquet', year, year, month, zone) as specifier
      from (select distinct year from delivered) y, (select distinct zone from delivered) z, (select unnest(range(1, 13)) as month) m
      where year <= 2017
    union all
    select year, month(d), day(d), printf('%d/AIS_%d_%02d_%02d.parquet', year, year, month(d), day(d))
      from (select year, unnest(range(make_date(year, 1, 1), make_date(year + 1, 1, 1), interval 1 day)) as d
            from (select distinct year from delivered where year > 2017))""",
)


def _delivered(spark, sf):
    return inputs.table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "cast(2015 + o_custkey % 7 as int) as year",
        "cast(1 + o_orderkey % 12 as int) as month",
        "cast(1 + o_orderkey % 28 as int) as day",
        "cast(16 + o_custkey % 2 as int) as zone",
    )


def _with_specifier(df):
    zoned = F.col("year") <= 2017
    return df.withColumn(
        "specifier",
        F.format_string(
            "%d/AIS_%d_%02d_%s%02d.parquet", "year", "year", "month",
            F.when(zoned, "Zone").otherwise(""), F.when(zoned, F.col("zone")).otherwise(F.col("day")),
        ),
    )


def _expected(spark, sf):
    files = _delivered(spark, sf)
    return catalogue.expected_partitions(files.select("year").distinct(), files.select("zone").distinct(), "parquet")


@query(
    "expected_partitions",
    """select cast(year as bigint) as year, cast(month as bigint) as month, cast(zone_or_day as bigint) as zone_or_day,
      specifier from calendar""",
)
def _(spark, sf):
    return _expected(spark, sf).select(*big("year", "month", "zone_or_day"), "specifier")


@query(
    "missing_partitions",
    f"""select specifier, count(*) over () as remaining, (select count(*) from calendar) as total
      from calendar where specifier not in (select {SPECIFIER} from delivered)""",
)
def _(spark, sf):
    present = _with_specifier(_delivered(spark, sf))
    return catalogue.missing_partitions(_expected(spark, sf), present).select("specifier", *big("remaining", "total"))


cte("named_files", f"select o_orderkey, 'landing/' || {SPECIFIER} as path, year, month, day, zone from delivered")
PARTS = """printf('%d', year) as year, printf('%02d', month) as month,
  printf('%02d', case when year <= 2017 then zone else day end) as zone_or_day, 'parquet' as extension"""


def _named(spark, sf):
    return _with_specifier(_delivered(spark, sf)).select(
        "o_orderkey", F.concat(F.lit("landing/"), "specifier").alias("path")
    )


@query("parse_specifier", f"select o_orderkey, path, {PARTS} from named_files")
def _(spark, sf):
    return catalogue.parse_specifier(_named(spark, sf), "path")


@query(
    "partition_time_bounds",
    """select o_orderkey, epoch_us(cast(lo as timestamp)) // 1000000 as min_time,
      epoch_us(cast(hi as timestamp)) // 1000000 + 86399 as max_time
    from (select o_orderkey, case when year <= 2017 then make_date(year, month, 1) else make_date(year, month, day) end as lo,
      case when year <= 2017 then last_day(make_date(year, month, 1)) else make_date(year, month, day) end as hi from named_files)""",
)
def _(spark, sf):
    parsed = catalogue.parse_specifier(_named(spark, sf), "path")
    return catalogue.partition_time_bounds(parsed).select("o_orderkey", "min_time", "max_time")


@query("utm_zone", "select event_id, cast(floor((lon + 180) / 6) as bigint) + 1 as zone from ais")
def _(spark, sf):
    return inputs.messages(spark, sf).select("event_id", utm_zone(F.col("lat"), F.col("lon")).alias("zone"))


@query("zone_union", "select event_id, mmsi, case when lon < -84 then 'Zone16' else 'Zone17' end as zone from ais")
def _(spark, sf):
    m = inputs.messages(spark, sf)
    zones = {"Zone16": m.where(F.col("lon") < -84), "Zone17": m.where(F.col("lon") >= -84)}
    return messages.union_zones(zones).select("event_id", "mmsi", "zone")


@query(
    "lookup_dims",
    """select 'vessel' as dim, v.type_text as code, v.vessel_group as text, count(*) as n
      from ais join vessel_types v on v.type_text = cast(cast(vessel_type as int) as varchar) group by all
    union all
    select 'status', cast(s.status_code as varchar), s.status_text, count(*)
      from ais join status_names s on s.status_text = lower(status) group by all""",
)
def _(spark, sf):
    m = inputs.messages(spark, sf)
    vessels = m.join(F.broadcast(vessel_dim(spark)), F.col("vessel_type").cast("int").cast("string") == F.col("type_text"))
    states = m.join(F.broadcast(status_dim(spark)), F.lower("status") == F.col("status_text"))
    return (
        vessels.groupBy(F.lit("vessel").alias("dim"), F.col("type_text").alias("code"), F.col("vessel_group").alias("text"))
        .agg(F.count(F.lit(1)).alias("n"))
        .unionByName(
            states.groupBy(
                F.lit("status").alias("dim"), F.col("status_code").cast("string").alias("code"), F.col("status_text").alias("text")
            ).agg(F.count(F.lit(1)).alias("n"))
        )
    )


LONGITUDES = [f"{(36000 - 8558 + 18 * j) / 100:.2f}" for j in range(24)]


@query(
    "currents_long",
    """select latitude, longitude, water_u as speed, cast(year(ts) as bigint) as year, cast(month(ts) as bigint) as month,
      cast(day(ts) as bigint) as day, cast(hour(ts) as bigint) as hour
    from (select a.latitude, l.longitude, t.time, make_timestamp(t.time * 1000000) as ts, c.water_u
      from (select distinct latitude, time from current_cells) t
      join (select distinct latitude from current_cells) a using (latitude)
      cross join (select (j * 18 - 8558) / cast(100 as double) as longitude from range(24) r(j)) l
      left join current_cells c on c.latitude = a.latitude and c.longitude = l.longitude and c.time = t.time)""",
)
def _(spark, sf):
    cells = inputs.current_cells(spark, sf).withColumn(
        "column", F.format_string("%.2f", F.col("longitude") + 360.0)
    )
    matrix = cells.groupBy("time", "latitude").pivot("column", LONGITUDES).agg(F.max("water_u"))
    out = currents.currents_to_long(matrix, LONGITUDES)
    return out.select("latitude", "longitude", "speed", *big("year", "month", "day", "hour"))


cte(
    "ship_boxes",
    """select mmsi, min(lat) as lat_1, max(lat) as lat_2, min(lon) - (event_shift % 3) * 30 as lon_1, max(lon) - (event_shift % 3) * 30 as lon_2
      from (select *, cast(mmsi as bigint) % 4 as event_shift from ais) group by mmsi, event_shift""",
)


@query(
    "region_lookup",
    """select mmsi, cast(case when lat_1 >= 0 and lat_2 <= 70 and lon_1 >= -99.99996948242188 and lon_2 <= -50 then 1
      when lat_1 >= 10 and lat_2 <= 70 and lon_1 >= -150.00001525878906 and lon_2 <= -210 then 6
      when lat_1 >= 10 and lat_2 <= 60 and lon_1 >= -149.99996948242188 and lon_2 <= -100 then 7
      when lat_1 >= 60 and lat_2 <= 80 and lon_1 >= -179.99996948242188 and lon_2 <= -120 then 17 end as bigint) as region from ship_boxes""",
)
def _(spark, sf):
    shift = (F.col("mmsi").cast("bigint") % 4) % 3 * 30
    boxes = inputs.messages(spark, sf).withColumn("_shift", shift).groupBy("mmsi", "_shift").agg(
        F.min("lat").alias("lat_1"), F.max("lat").alias("lat_2"), F.min("lon").alias("lon_1"), F.max("lon").alias("lon_2")
    )
    moved = boxes.withColumns({"lon_1": F.col("lon_1") - F.col("_shift"), "lon_2": F.col("lon_2") - F.col("_shift")})
    return currents.region_for_box(moved, strict=False).select("mmsi", *big("region"))


@query(
    "margin_slice",
    """select cast(min(i) as bigint) as min_index, cast(max(i) as bigint) as max_index, count(*) as n_values from (
      select latitude, row_number() over (order by latitude) - 1 as i from (select distinct latitude from current_cells))
      where latitude between 26.5 and 28.5""",
)
def _(spark, sf):
    axis = inputs.current_cells(spark, sf).agg(F.array_sort(F.collect_set("latitude")).alias("axis"))
    axis = axis.select(F.posexplode("axis").alias("axis_index", "value"))
    return currents.margin_slice(axis, 27.5, 27.5, 1.0)


@query(
    "save_dataset",
    """select track, mmsi, event_id, base_datetime, lat, lon, sog, cog, heading, vessel_group, count(*) over () as n_written
      from long_rows""",
)
def _(spark, sf):
    rows = inputs.long_tracks(spark, sf).drop("_chunk")
    saved, n = sinks.save_split(rows, work_folder(spark, "split"))
    return saved.withColumn("n_written", F.lit(n).cast("bigint"))


cte(
    "dataset_rows",
    """select *, split || '_long_term_train' as dataset from train_window_rows where split in ('train', 'valid')
      union all select *, split || '_long_term_test' from test_window_rows where split in ('valid', 'test')""",
)
