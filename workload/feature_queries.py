"""Features on windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.storage import cut
from keelson.operators import currents as water
from keelson.operators import features as fx
from keelson.operators import nearest
from keelson.operators import window_features as wf
from keelson.operators import windows
from keelson.plans import features as plans
from workload import inputs
from workload.inputs import BOX, CFG
from workload.current_queries import long, wide
from workload.registry import big, cte, haversine_sql, q4, q4_sql, query

KEY_SQL = "track, cast(window_id as bigint) as window_id"
STEP_SQL = f"{KEY_SQL}, cast(step as bigint) as step"
GAP = 3600
TEST_CUT = (windows.Cut("test", CFG.history),)
WK = "(partition by track, window_id)"


def key(step=True):
    return ["track", *big("window_id", *(["step"] if step else []))]


def test_rows(spark, sf):
    return windows.test_windows(inputs.resampled(spark, sf), CFG)


def history(spark, sf):
    return windows.select_x_steps(test_rows(spark, sf), CFG, GAP)


def histories(spark, sf, columns):
    """The history part of every test window, one row per window with an array per column; one shuffle."""
    blocks = windows.window_blocks(inputs.resampled(spark, sf), CFG, columns)
    return wf.select_steps(windows.windows_of(blocks, CFG, TEST_CUT), windows.x_steps(CFG, GAP))


def history_rows(df):
    return wf.step_rows(df, windows.x_steps(CFG, GAP))


cte("history_rows", "select * from test_window_rows where step < 5")


@query("history_steps", f"select {STEP_SQL}, {q4_sql('lat')} as lat from test_window_rows where step in (2, 3, 4)")
def _(spark, sf):
    return fx.select_history(test_rows(spark, sf), CFG, 2, GAP).select(*key(), q4(F.col("lat")).alias("lat"))


@query(
    "target_step",
    f"""select 'direct' as model, {STEP_SQL}, {q4_sql('lat')} as lat from test_window_rows where step = 6
      union all select 'iterative', {STEP_SQL}, {q4_sql('lat')} from test_window_rows where step = 5
      union all select 'iterative test', {STEP_SQL}, {q4_sql('lat')} from test_window_rows where step >= 5""",
)
def _(spark, sf):
    rows = test_rows(spark, sf)
    picks = {
        "direct": fx.select_target(rows, CFG, GAP, 2),
        "iterative": fx.select_target(rows, CFG, GAP, 2, "iterative"),
        "iterative test": fx.select_target(rows, CFG, GAP, 2, "iterative", test=True),
    }
    parts = [d.select(F.lit(n).alias("model"), *key(), q4(F.col("lat")).alias("lat")) for n, d in picks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


LOCAL = "timezone('America/Los_Angeles', timezone('UTC', make_timestamp(base_datetime * 1000000)))"


@query(
    "hour_day_of_week",
    f"select event_id, cast(hour({LOCAL}) as bigint) as hour, cast(isodow({LOCAL}) - 1 as bigint) as day_of_week from ais",
)
def _(spark, sf):
    return fx.with_local_time(inputs.messages(spark, sf)).select("event_id", *big("hour", "day_of_week"))


_STATS = [f"{c}_{s}" for c in ("sog", "cog") for s in ("min", "median", "max")]
_STATS_SQL = ", ".join(f"{q4_sql(f'{s}({c}) over {WK}')} as {c}_{s}" for c in ("sog", "cog") for s in ("min", "median", "max"))


@query("sog_cog_stats", f"select {STEP_SQL}, {_STATS_SQL} from history_rows")
def _(spark, sf):
    described = wf.with_window_stats(histories(spark, sf, ["sog", "cog"]))
    return history_rows(described).select(*key(), *[q4(F.col(c)).alias(c) for c in _STATS])


cte(
    "distance_rows",
    f"""select *, {haversine_sql('lat_0', 'lon_0', 'lat_1', 'lon_1')} as distance_traveled from (
      select *, arg_min(lat, step) over {WK} as lat_0, arg_min(lon, step) over {WK} as lon_0,
        arg_max(lat, step) over {WK} as lat_1, arg_max(lon, step) over {WK} as lon_1 from history_rows)""",
)


@query("distance_traveled", f"select {STEP_SQL}, {q4_sql('distance_traveled')} as distance_traveled from distance_rows")
def _(spark, sf):
    described = wf.with_window_distance(histories(spark, sf, ["lat", "lon"]))
    return history_rows(described).select(*key(), q4(F.col("distance_traveled")).alias("distance_traveled"))


_EAST = "cos(radians(lat_b)) * sin(radians(lon_b - lon))"
_NORTH = "cos(radians(lat)) * sin(radians(lat_b)) - sin(radians(lat)) * cos(radians(lat_b)) * cos(radians(lon_b - lon))"
cte(
    "bearing_rows",
    f"""select *, avg(angle) over {WK} as mean_bearing_angle, stddev_pop(angle) over {WK} as std_bearing_angle from (
      select *, case when lat_b is not null then case when degrees(atan2({_EAST}, {_NORTH})) < 0
        then degrees(atan2({_EAST}, {_NORTH})) + 360 else degrees(atan2({_EAST}, {_NORTH})) end end as angle
      from (select *, lead(lat) over (partition by track, window_id order by step) as lat_b,
              lead(lon) over (partition by track, window_id order by step) as lon_b from history_rows))""",
)


@query(
    "bearing_stats",
    f"select {STEP_SQL}, {q4_sql('mean_bearing_angle')} as mean_bearing_angle, {q4_sql('std_bearing_angle')} as std_bearing_angle from bearing_rows",
)
def _(spark, sf):
    names = ["mean_bearing_angle", "std_bearing_angle"]
    described = wf.with_window_bearings(histories(spark, sf, ["lat", "lon"]))
    return history_rows(described).select(*key(), *[q4(F.col(c)).alias(c) for c in names])


def packed(spark, sf):
    """Scaled u and v of the kept cells, one array per stamp."""
    parts = []
    for variable in ("water_u", "water_v"):
        kept = water.drop_sparse(water.with_coord(water.thin_grid(water.currents_bbox(long(spark, sf, variable), BOX))))
        parts.append(water.scale_int16(kept))
    return water.pack_currents(*parts)


def with_currents(spark, sf):
    """Resampled rows with packed, gap-filled currents, and the index of the cells nearest to them."""
    rows, stamps = cut(inputs.resampled(spark, sf)), cut(packed(spark, sf))
    index = cut(nearest.near_index(rows, nearest.grid_of(stamps)))
    return water.append_packed(rows, stamps, fx.describe_currents), index


# Cells per stamp, and the mean cells that stand in for missing stamps.
cte("cells", "select u.*, v.speed as v from scaled_water_u u join scaled_water_v v using (latitude, longitude, year, month, day, hour)")
cte(
    "stamped",
    "select *, day(make_timestamp(base_datetime * 1000000)) as day, hour(make_timestamp(base_datetime * 1000000)) // 3 * 3 as hour from resampled",
)
cte("seen_stamps", "select distinct year, month, day, hour from cells")
cte(
    "mean_cells",
    """select latitude, longitude, round_even(sum(c.speed * n) / cast(sum(n) as double), 0) as speed, round_even(sum(c.v * n) / cast(sum(n) as double), 0) as v
      from cells c left join (select year, month, day, hour, cast(count(*) as bigint) as n from stamped where split = 'train' group by all) using (year, month, day, hour)
      group by latitude, longitude""",
)
cte(
    "row_cells",
    """select s.track, s.base_datetime, s.split, s.lat, s.lon, m.latitude, m.longitude,
        cast(coalesce(c.speed, cast(m.speed as smallint)) as double) as u, cast(coalesce(c.v, cast(m.v as smallint)) as double) as v
      from stamped s cross join mean_cells m left join cells c using (year, month, day, hour, latitude, longitude)""",
)
_COMPONENTS = ["water_u_mean", "water_u_std", "water_v_mean", "water_v_std"]
cte(
    "row_stats",
    """select track, base_datetime, avg(abs(u)) as water_u_mean, stddev_pop(u) as water_u_std, avg(abs(v)) as water_v_mean,
      stddev_pop(v) as water_v_std, avg(sqrt(u * u + v * v)) as mean_current_magnitude, stddev_pop(sqrt(u * u + v * v)) as std_current_magnitude
      from row_cells group by track, base_datetime""",
)


def _q(names):
    return ", ".join(f"{q4_sql(n)} as {n}" for n in names)


@query("current_component_stats", f"select track, base_datetime, {_q(_COMPONENTS)} from row_stats")
def _(spark, sf):
    rows = water.append_packed(cut(inputs.resampled(spark, sf)), cut(packed(spark, sf)), fx.with_component_stats)
    return rows.select("track", "base_datetime", *[q4(F.col(c)).alias(c) for c in _COMPONENTS])


_MAGNITUDES = ["mean_current_magnitude", "std_current_magnitude"]


@query("current_magnitude_stats", f"select track, base_datetime, {_q(_MAGNITUDES)} from row_stats")
def _(spark, sf):
    # From the wide table this time: the columns are gathered row by row.
    joined = water.append_currents(inputs.resampled(spark, sf), wide(spark, sf))
    out = fx.with_magnitude_stats(fx.pack_wide(joined))
    return out.select("track", "base_datetime", *[q4(F.col(c)).alias(c) for c in _MAGNITUDES])


@query(
    "last_step_with_path",
    f"""select h.track, cast(h.window_id as bigint) as window_id, cast(h.step as bigint) as at, {q4_sql('h.lat')} as lat, {q4_sql('h.lon')} as lon,
      l.base_datetime as last_time, {q4_sql('l.sog')} as last_sog
      from history_rows h join history_rows l on l.track = h.track and l.window_id = h.window_id and l.step = 4""",
)
def _(spark, sf):
    last = wf.last_steps(histories(spark, sf, ["lat", "lon", "base_datetime", "sog"]))
    path = last.select("track", "window_id", "base_datetime", "sog", F.posexplode(F.arrays_zip("lats", "lons")).alias("at", "p"))
    return path.select(
        "track", *big("window_id", "at"), q4(F.col("p.lats")).alias("lat"), q4(F.col("p.lons")).alias("lon"),
        F.col("base_datetime").alias("last_time"), q4(F.col("sog")).alias("last_sog"),
    )


cte(
    "near_cells",
    f"""select *, row_number() over (partition by track, base_datetime order by km, latitude, longitude) as nth from (
      select *, floor({haversine_sql('lat', 'lon', 'latitude', 'longitude')} * 1000000 + cast(0.5 as double)) as km from row_cells)""",
)
_NEAR = [f"{n}_closest_weather_magnitude_{s}" for n in fx.NEAREST_COUNTS for s in ("mean", "std") if (n, s) != (1, "std")]
_NEAR_SQL = ", ".join(
    ("{} as \"{}\"").format(
        q4_sql(f"{'avg' if name.endswith('mean') else 'stddev_samp'}(sqrt(u * u + v * v)) filter (nth <= {name.split('_')[0]})"), name
    )
    for name in _NEAR
)


@query("nearest_currents_stats", f"select track, base_datetime, {_NEAR_SQL} from near_cells group by track, base_datetime")
def _(spark, sf):
    out = nearest.nearest_stats(*with_currents(spark, sf))
    return out.select("track", "base_datetime", *[q4(F.col(f"`{c}`")).alias(c) for c in _NEAR])


@query("nearest_currents_arrays", "select track, base_datetime, cast(nth - 1 as bigint) as at, u, v, latitude as lat, longitude as lon from near_cells where nth <= 35")
def _(spark, sf):
    arrays = ["closest_weather_us", "closest_weather_vs", "closest_weather_lats", "closest_weather_lons"]
    out = nearest.nearest_arrays(*with_currents(spark, sf))
    cell = out.select("track", "base_datetime", F.posexplode(F.arrays_zip(*arrays)).alias("at", "c"))
    return cell.select(
        "track", "base_datetime", *big("at"),
        *[F.col(f"c.{a}").cast("double").alias(n) for a, n in zip(arrays, ("u", "v", "lat", "lon"))],
    )


@query("undo_one_hot", "select track, base_datetime, vessel_group from resampled")
def _(spark, sf):
    rows = inputs.resampled(spark, sf)
    hot = windows.one_hot(rows, windows.learn_levels(rows, ["vessel_group"]))
    return fx.undo_one_hot(hot, "vessel_group").select("track", "base_datetime", "vessel_group")


def _bin_sql(column, size, cutoff):
    low = f"cast(floor({column} / {size}) * {size} as int)"
    label = f"'[' || {low} || ', ' || ({low} + {size}) || ')'"
    return label if cutoff is None else f"case when {low} < {cutoff} then {label} else '[{cutoff}+]' end"


def one_hot_rows(spark, sf):
    rows = history(spark, sf).drop("mmsi", "heading", "split")
    return windows.one_hot(rows, {"vessel_group": sorted(CFG.vessel_groups)})


_HOT_LEVELS = sorted(CFG.vessel_groups)
_HOT_SQL = ", ".join(f"""vessel_group = '{v}' as "vessel_group_{v}" """ for v in _HOT_LEVELS)


@query("drop_column_groups", f"select {STEP_SQL}, {q4_sql('lat')} as lat, {q4_sql('lon')} as lon, {_HOT_SQL} from history_rows")
def _(spark, sf):
    rows = one_hot_rows(spark, sf).withColumns(
        {
            "1.0_2.0_water_u": F.lit(1), "weather_is_imputed": F.lit(True),
            "destination_cluster_-1": F.lit(True), "destination_cluster_lat_center": F.lit(1.0),
        }
    )
    out = fx.drop_groups(rows, sog_cog="ignore").drop("year", "month")
    return out.withColumns({"lat": q4(F.col("lat")), "lon": q4(F.col("lon"))}).select(
        *key(), "lat", "lon", *[f"vessel_group_{v}" for v in _HOT_LEVELS]
    )


_FEATURE_COLUMNS = ["base_datetime", "lat", "lon", "sog", "cog"]


@query(
    "column_catalogue",
    " union all ".join(
        f"""select cast({i} as bigint) as original_index, '{c}' as "column", {f"'{g}'" if g else 'cast(null as varchar)'} as column_group,
          count({x}) as filled from history_rows"""
        for i, (c, x, g) in enumerate(
            [(c, c, None) for c in _FEATURE_COLUMNS] + [(f"vessel_group_{v}", "vessel_group", "vessel_group") for v in _HOT_LEVELS]
        )
    ),
)
def _(spark, sf):
    rows = one_hot_rows(spark, sf).select(*_FEATURE_COLUMNS, *[f"vessel_group_{v}" for v in _HOT_LEVELS])
    return fx.column_catalogue(rows).select(*big("original_index"), "column", "column_group", *big("filled"))


_WATER_SQL = """(select track, base_datetime, split, lat, lon, sog, cog, year, month, sog as speed_1, cog as speed_2, sog * 2 as water_1 from resampled where split = 'train')"""
cte(
    "ranges",
    f"""select 'lat' as "column", cast(26 as double) as "min", cast(29 as double) as "max"
      union all select 'lon', cast(-85.5 as double), cast(-81.5 as double)
      union all select 'year', cast(2024 as double), cast(2024 as double)
      union all select 'month', cast(1 as double), cast(12 as double)
      union all select 'sog', min(sog), max(sog) from {_WATER_SQL}
      union all select 'cog', min(cog), max(cog) from {_WATER_SQL}
      union all select 'water_1', min(water_1), max(water_1) from {_WATER_SQL}
      union all select unnest(['speed_1', 'speed_2']), least(min(speed_1), min(speed_2)), greatest(max(speed_1), max(speed_2)) from {_WATER_SQL}""",
)
_RANGED = ["lat", "lon", "sog", "cog", "year", "month", "speed_1", "speed_2", "water_1"]


def ranged_rows(spark, sf):
    """Rows of every dataset, and the ranges of the training rows."""
    rows = inputs.resampled(spark, sf)
    rows = cut(rows.withColumns({"speed_1": F.col("sog"), "speed_2": F.col("cog"), "water_1": F.col("sog") * 2}))
    return rows, fx.fit_normalizer(rows.where(F.col("split") == "train"), BOX, CFG.years, _RANGED)


@query("normalization_factors", f"""select "column", {q4_sql('"min"')} as "min", {q4_sql('"max"')} as "max" from ranges""")
def _(spark, sf):
    _, out = ranged_rows(spark, sf)
    return out.select("column", q4(F.col("min")).alias("min"), q4(F.col("max")).alias("max"))


def _scaled_sql(c):
    low, high = (f"""(select "{e}" from ranges where "column" = '{c}')""" for e in ("min", "max"))
    return f"{q4_sql(f'case when {high} = {low} then 0 else ({c} - {low}) / ({high} - {low}) end')} as {c}"


_EVERY_SQL = _WATER_SQL.replace(" where split = 'train'", "")


def normalized(spark, sf):
    rows, fitted = ranged_rows(spark, sf)
    return fx.normalize(rows, fx.factors(fitted)).select("track", "base_datetime", "split", *[q4(F.col(c)).alias(c) for c in _RANGED])


def unnormalized(spark, sf):
    rows, fitted = ranged_rows(spark, sf)
    ranges = fx.factors(fitted)
    back = fx.unnormalize(fx.normalize(rows, ranges), ranges, ["lat", "lon", "sog"])
    return back.select("track", "base_datetime", "split", *[q4(F.col(c)).alias(c) for c in ("lat", "lon", "sog")])


# Every split under the ranges of the training rows; both under the operator's name and the earlier one.
for _name in ("normalize", "normalize_datasets"):
    query(_name, f"select track, base_datetime, split, {', '.join(_scaled_sql(c) for c in _RANGED)} from {_EVERY_SQL}")(normalized)
for _name in ("unnormalize", "unnormalize_datasets"):
    query(_name, f"select track, base_datetime, split, {_q(['lat', 'lon', 'sog'])} from resampled")(unnormalized)


@query(
    "fusion_split",
    f"""select 'recurrent' as half, {STEP_SQL}, {q4_sql('lat')} as lat, cast(null as double) as cog from history_rows
      union all select 'dense', {KEY_SQL}, cast(null as bigint), null, {q4_sql('cog')} from history_rows where step = 4""",
)
def _(spark, sf):
    rows = history(spark, sf)
    recurrent, dense = fx.fusion_split(rows, ["lat", "lon"], 4)
    return recurrent.select(
        F.lit("recurrent").alias("half"), *key(), q4(F.col("lat")).alias("lat"), F.lit(None).cast("double").alias("cog")
    ).unionByName(
        dense.select(
            F.lit("dense").alias("half"), *key(False), F.lit(None).cast("bigint").alias("step"),
            F.lit(None).cast("double").alias("lat"), q4(F.col("cog")).alias("cog"),
        )
    )


cte("grid_lons", "select longitude, row_number() over (order by longitude desc) - 1 as lon_at from (select distinct longitude from cells)")
cte("grid_lats", "select latitude, row_number() over (order by latitude) - 1 as lat_at from (select distinct latitude from cells)")


@query(
    "weather_grid",
    """select year, month, day, hour, lon_at, lat_at, cast(coalesce(c.speed, 0.5) as double) as u, cast(coalesce(c.v, 0.5) as double) as v,
      cast(case when c.speed is null then 1 when hour % 2 = 1 then 0.5 else 0 end as double) as mask
      from (select cast(year as bigint) as year, cast(month as bigint) as month, cast(day as bigint) as day, cast(hour as bigint) as hour from seen_stamps) s
      cross join grid_lons cross join grid_lats left join cells c using (year, month, day, hour, latitude, longitude)""",
)
def _(spark, sf):
    # One row per stamp; odd hours stand for imputed rows.
    stamps = cut(packed(spark, sf)).withColumn("weather_is_imputed", F.col("hour") % 2 == 1)
    frame = fx.grid_frame(stamps.select(F.inline("currents")))
    grid = fx.weather_grid(stamps, frame).select(*big(*water.STAMP), F.posexplode("grid").alias("lon_at", "_row"))
    cells = grid.select(*water.STAMP, "lon_at", F.posexplode("_row").alias("lat_at", "_cell"))
    value = F.col("_cell")
    return cells.select(
        *water.STAMP, *big("lon_at", "lat_at"), value[0].alias("u"), value[1].alias("v"), value[2].alias("mask")
    )


@query("target_columns", f"select {KEY_SQL}, {q4_sql('lat')} as lat, {q4_sql('lon')} as lon from test_window_rows where step = 6")
def _(spark, sf):
    out = fx.select_targets(fx.select_target(test_rows(spark, sf), CFG, GAP, 2))
    return out.select(*key(False), q4(F.col("lat")).alias("lat"), q4(F.col("lon")).alias("lon"))


RUN = plans.Run(gap=GAP, history_hours=3, hours_out=2)
_PLANNED = ["hour", "day_of_week", *_STATS, "distance_traveled"]

# One plan on all parts of every dataset; numbers of windows repeat between datasets.
ITERATIVE = plans.Run(gap=GAP, history_hours=3, hours_out=2, model="iterative", sog_cog="raw")
cte("dataset_history", "select * from dataset_rows where step in (1, 2, 3, 4)")
WD = "(partition by dataset, track, window_id)"
cte(
    "dataset_plan",
    f"""select dataset, track, window_id, step, lat, lon, sog, cog, year, month, cast(hour({LOCAL}) as double) as hour, cast(isodow({LOCAL}) - 1 as double) as day_of_week,
      min(sog) over {WD} as sog_min, median(sog) over {WD} as sog_median, max(sog) over {WD} as sog_max,
      min(cog) over {WD} as cog_min, median(cog) over {WD} as cog_median, max(cog) over {WD} as cog_max,
      {haversine_sql(f'(arg_min(lat, step) over {WD})', f'(arg_min(lon, step) over {WD})', f'(arg_max(lat, step) over {WD})', f'(arg_max(lon, step) over {WD})')} as distance_traveled
      from dataset_history""",
)
_TRAINED = "filter (where dataset = 'train_long_term_train') over ()"
_FITTED = ["sog", "cog", *_PLANNED]
_FITTED_SQL = ", ".join(f"({c} - min({c}) {_TRAINED}) / (max({c}) {_TRAINED} - min({c}) {_TRAINED}) as {c}" for c in _FITTED)
cte(
    "dataset_scaled",
    f"""select dataset, track, window_id, step, (lat - 26) / 3 as lat, (lon + 85.5) / 4 as lon, cast(year - 2024 as double) as year,
      (month - 1) / cast(11 as double) as month, {_FITTED_SQL} from dataset_plan""",
)
cte("trained_ranges", "select " + ", ".join(f"min({c}) as {c}_low, max({c}) as {c}_high" for c in ("sog", "cog")) + " from dataset_plan where dataset = 'train_long_term_train'")
cte(
    "dataset_targets",
    """select dataset, track, window_id, step, (lat - 26) / 3 as lat, (lon + 85.5) / 4 as lon,
      (sog - sog_low) / (sog_high - sog_low) as sog, (cog - cog_low) / (cog_high - cog_low) as cog from dataset_rows, trained_ranges where step >= 5""",
)
_SHAPED = ["lat", "lon", "sog", "cog", "year", "month", *_PLANNED]
_PARTS = {  # model and part: columns, whether steps are numbered, source
    ("direct", "x"): ([c for c in _SHAPED if c not in ("sog", "cog")], True, "dataset_scaled"),
    ("direct", "y"): (["lat", "lon"], False, "dataset_targets where step = 6"),
    ("direct", "recurrent"): (["lat", "lon", "hour", "day_of_week"], True, "dataset_scaled"),
    ("direct", "dense"): (["year", "month", *_STATS, "distance_traveled"], False, "dataset_scaled where step = 4"),
    ("iterative", "x"): (["lat", "lon", "sog", "cog", "year", "month", "hour", "day_of_week", "distance_traveled"], True, "dataset_scaled"),
    ("iterative", "y"): (["lat", "lon", "sog", "cog"], True, "dataset_targets where step = 5 or dataset like '%_test'"),
}


def _part_sql(model, part, columns, numbered, source):
    values = ", ".join(f"{q4_sql(c) if c in columns else 'cast(null as double)'} as {c}" for c in _SHAPED)
    step = "step" if numbered else "null"
    return f"select dataset, '{model}' as model, '{part}' as part, {KEY_SQL}, cast({step} as bigint) as step, {values} from {source}"


def planned(spark, sf):
    rows = inputs.resampled(spark, sf).drop("mmsi", "vessel_group", "heading")
    whole = windows.windows_of(cut(plans.blocks_for(rows, RUN, CFG)), CFG, windows.dataset_cuts(CFG))
    shaped = []
    for run, model, parts in ((RUN, "direct", plans.PARTS), (ITERATIVE, "iterative", ("x", "y"))):
        out = plans.shape(whole, run, CFG, plans.fit_ranges(whole, run, CFG, BOX), parts)
        there = {c: F.col(c) if c in out.columns else F.lit(None).cast("double") for c in _SHAPED}
        values = [q4(value).alias(c) for c, value in there.items()]
        shaped.append(out.select("dataset", F.lit(model).alias("model"), "part", *key(), *values))
    return shaped[0].unionByName(shaped[1])


for _name in ("transformation_plan", "transformation_plan_datasets"):
    query(_name, " union all ".join(_part_sql(*names, *of) for names, of in _PARTS.items()))(planned)


_ANALYSIS = ["mean_bearing_angle", "std_bearing_angle", "distance_traveled", *_COMPONENTS, *_MAGNITUDES, *_NEAR]
cte(
    "analysis_rows",
    f"""select b.track, b.window_id, b.base_datetime, b.sog, b.cog, b.mean_bearing_angle, b.std_bearing_angle, d.distance_traveled,
      s.* exclude (track, base_datetime), hour({LOCAL.replace('base_datetime', 'b.base_datetime')}) as hour
      from bearing_rows b join distance_rows d using (track, window_id, step) join row_stats s on s.track = b.track and s.base_datetime = b.base_datetime
      where b.step = 4""",
)
cte("near_stats", "select track, base_datetime, " + _NEAR_SQL + " from near_cells group by track, base_datetime")
_BIN_NAMES = [f"{c}_bin" for c, _, _ in fx.BINS]


@query(
    "analysis_dataset",
    f"""select a.track, cast(window_id as bigint) as window_id, cast(hour as bigint) as hour, {_q([c for c in _ANALYSIS if c not in _NEAR])},
      {', '.join(f'n."{c}"' for c in _NEAR)}, {', '.join(f'{_bin_sql(c, s, k)} as {c}_bin' for c, s, k in fx.BINS)}
      from analysis_rows a join near_stats n on n.track = a.track and n.base_datetime = a.base_datetime""",
)
def _(spark, sf):
    out = analysis(spark, sf)
    return out.select(*key(False), *big("hour"), *[q4(F.col(f"`{c}`")).alias(c) for c in _ANALYSIS], *_BIN_NAMES)


def analysis(spark, sf):
    rows, stamps = cut(inputs.resampled(spark, sf)), cut(packed(spark, sf))
    index = cut(nearest.near_index(rows, nearest.grid_of(stamps)))
    return plans.analysis_dataset(rows, stamps, index, CFG, GAP, TEST_CUT)


@query(
    "bin_labels",
    f"""select track, cast(window_id as bigint) as window_id, {', '.join(f'{_bin_sql(c, s, k)} as {c}_bin' for c, s, k in fx.BINS)} from analysis_rows""",
)
def _(spark, sf):
    return analysis(spark, sf).select(*key(False), *_BIN_NAMES)


@query(
    "head_sample",
    f"""select {STEP_SQL}, {q4_sql('lat')} as lat from test_window_rows join (
      select distinct track, window_id from test_window_rows order by track, window_id limit 500) using (track, window_id)""",
)
def _(spark, sf):
    return fx.head_sample(test_rows(spark, sf), 500).select(*key(), q4(F.col("lat")).alias("lat"))


@query(
    "epoch_batches",
    f"""select track, cast(window_id as bigint) as window_id, cast(batch as bigint) as batch from (
      select track, window_id, (row_number() over (order by md5('7|3|' || track || '|' || window_id), track || '|' || window_id) - 1) // 64 as batch
      from (select distinct track, window_id from train_window_rows))""",
)
def _(spark, sf):
    rows = windows.train_windows(inputs.resampled(spark, sf), CFG)
    return fx.epoch_batches(rows, 64, CFG.seed, 3).select(*key(False), *big("batch"))


@query(
    "shapes",
    """select dataset, count(*) as sequences, cast(max(n) as bigint) as steps, cast(5 as bigint) as features from (
      select dataset, track, window_id, count(*) as n from dataset_rows group by all) group by dataset""",
)
def _(spark, sf):
    out = fx.dataset_shapes(windows.window_datasets(inputs.resampled(spark, sf), CFG), 5)
    return out.select("dataset", *big("sequences", "steps", "features"))
