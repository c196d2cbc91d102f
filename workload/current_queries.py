"""Ocean currents: preparation and join."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import currents
from workload import inputs
from workload.inputs import BOX
from workload.registry import big, cte, q4, q4_sql, query

STAMP_SQL = ", ".join(f"cast({c} as bigint) as {c}" for c in currents.STAMP)
CELL_SQL = f"latitude, longitude, speed, {STAMP_SQL}"
IN_BOX = f"latitude between {BOX.lat_1} and {BOX.lat_2} and longitude between {BOX.lon_1} and {BOX.lon_2}"


def _axis_sql(column, source):
    return f"""select {column} from (select {column}, row_number() over (order by {column}) - 1 as i, count(*) over () as n
      from (select distinct {column} from {source})) where i % cast(round_even(n / cast(13 as double), 0) as bigint) = 0"""


for _v in ("water_u", "water_v"):
    cte(f"box_{_v}", f"select * from long_{_v} where {IN_BOX}")
    cte(
        f"thin_{_v}",
        f"""select *, cast(latitude as varchar) || '_' || cast(longitude as varchar) as coord from box_{_v}
          where speed is not null and latitude in ({_axis_sql('latitude', f'box_{_v}')})
            and longitude in ({_axis_sql('longitude', f'box_{_v}')})""",
    )
    cte(
        f"dense_{_v}",
        f"""select * from thin_{_v} where coord in (select coord from thin_{_v} group by coord
          having 1 - count(distinct (year, month, day, hour)) / cast((select count(distinct (year, month, day, hour)) from thin_{_v}) as double) <= 0.5)""",
    )
    cte(f"scaled_{_v}", f"select * replace (cast(trunc(speed * 1000) as smallint) as speed) from dense_{_v}")

# The cells that survive, by the rule the grid is made with: every second line, no land, no sporadic cells.
COORDS = sorted(
    f"{(i * 13 + 2590) / 100}_{(j * 18 - 8558) / 100}"
    for i in range(1, 24, 2)
    for j in range(1, 23, 2)
    if (i + j) % 9 and i * j % 7 != 3
)


def _wide_sql(variable, source):
    columns = ", ".join(f"""max(case when coord = '{c}' then speed end) as "{c}_{variable}" """ for c in COORDS)
    return f"select year, month, day, hour, {columns} from {source} group by year, month, day, hour"


for _v in ("water_u", "water_v"):
    cte(f"wide_{_v}", _wide_sql(_v, f"scaled_{_v}"))
cte("wide_currents", "select * from wide_water_u join wide_water_v using (year, month, day, hour)")
WATER = [f"{c}_{v}" for v in ("water_u", "water_v") for c in COORDS]
QUOTED = ", ".join(f'"{c}"' for c in WATER)


def long(spark, sf, variable="water_u"):
    return inputs.current_long(spark, sf, variable)


def cells(df):
    return df.select("latitude", "longitude", "speed", *big(*currents.STAMP))


def thinned(spark, sf, variable="water_u"):
    return currents.with_coord(currents.thin_grid(currents.currents_bbox(long(spark, sf, variable), BOX)))


def wide(spark, sf):
    tables = {v: long(spark, sf, v) for v in ("water_u", "water_v")}
    return currents.aggregate_currents(tables, BOX)


@query("currents_bbox", f"select {CELL_SQL} from box_water_u")
def _(spark, sf):
    return cells(currents.currents_bbox(long(spark, sf), BOX))


@query("thin_grid", f"select {CELL_SQL} from thin_water_u")
def _(spark, sf):
    return cells(currents.thin_grid(currents.currents_bbox(long(spark, sf), BOX)))


@query("coord_key", f"select coord, {CELL_SQL} from thin_water_u")
def _(spark, sf):
    return thinned(spark, sf).select("coord", "latitude", "longitude", "speed", *big(*currents.STAMP))


_WIDE_U = ", ".join(f'"{c}_water_u"' for c in COORDS)


@query("pivot_currents", f"select {STAMP_SQL}, {_WIDE_U} from ({_wide_sql('water_u', 'dense_water_u')})")
def _(spark, sf):
    out = currents.pivot_currents(currents.drop_sparse(thinned(spark, sf)), "water_u")
    return out.withColumns({c: F.col(c).cast("bigint") for c in currents.STAMP})


@query("drop_sparse_columns", "select distinct coord from dense_water_u")
def _(spark, sf):
    return currents.drop_sparse(thinned(spark, sf)).select("coord").distinct()


@query("scale_int16", f"select coord, speed, {STAMP_SQL} from scaled_water_u")
def _(spark, sf):
    out = currents.scale_int16(currents.drop_sparse(thinned(spark, sf)))
    return out.select("coord", "speed", *big(*currents.STAMP))


@query("join_variables", f"select {STAMP_SQL}, {QUOTED} from wide_currents")
def _(spark, sf):
    return wide(spark, sf).withColumns({c: F.col(c).cast("bigint") for c in currents.STAMP})


@query("floor_3h", "select event_id, cast(hour(ts) // 3 * 3 as bigint) as hour, cast(day(ts) as bigint) as day from events")
def _(spark, sf):
    out = currents.with_stamp(inputs.messages(spark, sf))
    return out.select("event_id", *big("hour", "day"))


cte(
    "joined",
    """select r.* exclude (mmsi, heading), w.* exclude (year, month, day, hour) from resampled r
      left join wide_currents w on w.year = r.year and w.month = r.month
        and w.day = day(make_timestamp(base_datetime * 1000000)) and w.hour = hour(make_timestamp(base_datetime * 1000000)) // 3 * 3""",
)
ROW = "track, base_datetime, vessel_group, split"


def joined(spark, sf):
    return currents.join_currents(currents.drop_join_columns(inputs.resampled(spark, sf)), wide(spark, sf))


def _water(df):
    return [F.col(f"`{c}`") for c in currents.water_columns(df)]


@query("join_currents", f"select {ROW}, {QUOTED} from joined")
def _(spark, sf):
    out = joined(spark, sf)
    return out.select(*ROW.split(", "), *_water(out))


_MEANS = ", ".join(f"""(select cast(round_even(avg("{c}"), 0) as smallint) from joined where split = 'train') as "{c}" """ for c in WATER)
cte("mean_row", "select " + ", ".join(f"""cast(round_even(avg("{c}"), 0) as smallint) as "{c}" """ for c in WATER) + " from joined where split = 'train'")


@query("train_means", "unpivot (select " + ", ".join(f'cast("{c}" as bigint) as "{c}"' for c in WATER) + " from mean_row) on " + QUOTED + " into name coord value mean")
def _(spark, sf):
    means = currents.train_means(joined(spark, sf).where(F.col("split") == "train"))
    return spark.createDataFrame(list(means.items()), "coord string, mean bigint")


_FILLED = ", ".join(f"""coalesce(j."{c}", m."{c}") as "{c}" """ for c in WATER)
cte("imputed", f"select j.* exclude ({QUOTED}), {_FILLED}, " + " or ".join(f'j."{c}" is null' for c in WATER) + " as weather_is_imputed from joined j, mean_row m")


@query("impute_means", f"select {ROW}, {QUOTED}, weather_is_imputed from imputed")
def _(spark, sf):
    out = currents.append_currents(inputs.resampled(spark, sf), wide(spark, sf))
    return out.select(*ROW.split(", "), *_water(out), "weather_is_imputed")


@query("imputed_flag", "select track, base_datetime, weather_is_imputed from imputed")
def _(spark, sf):
    return currents.with_imputed_flag(joined(spark, sf)).select("track", "base_datetime", "weather_is_imputed")


_AUDIT = ", ".join(f"""count(*) filter ("{c}" is null) as "{c}" """ for c in WATER)


@query(
    "null_audit",
    f"""select split, "column", cast(nulls as bigint) as nulls, {q4_sql('nulls * 100 / cast(n as double)')} as percent from (
      unpivot (select split, count(*) as n, {_AUDIT} from joined group by split) on {QUOTED} into name "column" value nulls)""",
)
def _(spark, sf):
    rows = joined(spark, sf)
    out = currents.null_audit(rows, currents.water_columns(rows))
    return out.select("split", "column", *big("nulls"), q4(F.col("percent")).alias("percent"))


@query("drop_join_columns", f"select track, base_datetime, {q4_sql('lat')} as lat, vessel_group, split from resampled")
def _(spark, sf):
    out = currents.drop_join_columns(inputs.resampled(spark, sf))
    return out.drop("row_index", "row_count", "year", "month", "lon", "sog", "cog").withColumn("lat", q4(F.col("lat")))
