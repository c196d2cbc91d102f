"""Common table expressions of the SQL twins: the stages between raw events and windows."""

from __future__ import annotations

from keelson.sources.dims import NAVIGATION_STATUSES, VESSEL_TYPES, group_text
from workload.inputs import CFG, EPOCH, MESSAGE_COLUMNS, SPLIT_SECOND
from workload.registry import cte, haversine_sql

GAP, CUTOFF, STEP = CFG.track_gap, CFG.speed_cutoff, CFG.step
W = "(partition by mmsi order by base_datetime, event_id)"
WT = "(partition by track order by base_datetime, event_id)"

cte(
    "ais",
    f"""select {MESSAGE_COLUMNS} from (
      select *, user_id * 1009 + cast((base_datetime - base_datetime % 7200) // 7200 as bigint) as k
      from (select *, epoch_us(ts) // 1000000 as base_datetime from events))""",
)
cte(
    "vessel_types",
    "select * from (values "
    + ", ".join(f"('{code}', '{group_text(group)}')" for code, group in VESSEL_TYPES)
    + ") v(type_text, vessel_group)",
)
cte(
    "status_names",
    "select * from (values "
    + ", ".join(f"('{text.lower()}', {code})" for code, text in NAVIGATION_STATUSES)
    + ") v(status_text, status_code)",
)
REPAIRED = """case when sog < 0 then sog + cast(102.6 as double) else sog end as sog,
      case when cog < 0 then cog + cast(409.6 as double) else cog end as cog,
      nullif(heading, cast(511 as double)) as heading"""
GROUPS = ", ".join(f"'{g}'" for g in CFG.vessel_groups)
GOOD_MMSI = "length(mmsi) = 9 and coalesce(try_cast(substr(mmsi, 1, 3) as int) between 201 and 775, false)"
cte(
    "graded",
    f"""select event_id, mmsi, base_datetime, lat, lon, {REPAIRED},
      coalesce(v.vessel_group, c.type_text) as vessel_group,
      coalesce(s.status_code, try_cast(c.status_text as int)) as status_code, {GOOD_MMSI} as good_mmsi
    from (select *, cast(coalesce(cast(trunc(vessel_type) as int), -1) as varchar) as type_text,
                 coalesce(lower(status), '-1') as status_text from ais) c
    left join vessel_types v on v.type_text = c.type_text
    left join status_names s on s.status_text = c.status_text""",
)
KEPT = "event_id, mmsi, base_datetime, lat, lon, sog, cog, heading, vessel_group"
cte(
    "attr",
    f"""select {KEPT} from graded where good_mmsi and vessel_group in ({GROUPS}) and status_code in (-1, 0, 8)""",
)


def moved_sql(source: str) -> str:
    return f"""select * exclude (pt, plat, plon),
      not (pt is null or base_datetime - pt > {GAP} or abs(lat - plat) + abs(lon - plon) <> 0) as stationary
    from (select *, lag(base_datetime) over {W} as pt, lag(lat) over {W} as plat, lag(lon) over {W} as plon
          from {source})"""


cte("moving", moved_sql("attr"))
GOOD_COURSE = "sog <= 30 and (heading is null or heading between 0 and 360) and cog between 0 and 360"
cte("valid_rows", f"select {KEPT} from moving where not stationary and {GOOD_COURSE}")


def speed_sql(source: str, keys: str = "mmsi") -> str:
    w = f"(partition by {keys} order by base_datetime, event_id)"
    nm_in = haversine_sql("lat", "lon", "plat", "plon") + " * cast(0.539956803 as double)"
    nm_out = haversine_sql("lat", "lon", "nlat", "nlon") + " * cast(0.539956803 as double)"
    inf = "cast('infinity' as double)"
    return f"""select * exclude (pt, nt, plat, plon, nlat, nlon, nm_in, nm_out),
      case when pt is null then null when base_datetime <> pt then nm_in / ((base_datetime - pt) / cast(3600 as double))
           when nm_in > 0 then {inf} end as prev_knots,
      case when nt is null then null when base_datetime <> nt then nm_out / ((nt - base_datetime) / cast(3600 as double))
           when nm_out > 0 then {inf} end as next_knots,
      (pt is null or base_datetime - pt > {GAP}) as is_first,
      (nt is null or nt - base_datetime > {GAP}) as is_last
    from (select *, {nm_in} as nm_in, {nm_out} as nm_out from (
      select *, lag(base_datetime) over {w} as pt, lead(base_datetime) over {w} as nt,
        lag(lat) over {w} as plat, lag(lon) over {w} as plon,
        lead(lat) over {w} as nlat, lead(lon) over {w} as nlon from {source}))"""


def kept_sql(source: str, complete: bool, keys: str = "mmsi") -> str:
    a = f"(coalesce(prev_knots > {CUTOFF}, false)" + (" or is_first)" if complete else ")")
    b = f"(coalesce(next_knots > {CUTOFF}, false)" + (" or is_last)" if complete else ")")
    return f"""select * exclude (prev_knots, next_knots, is_first, is_last) from ({speed_sql(source, keys)})
      where not (({a} and {b}) or (coalesce(prev_knots < 0.01, false) and not (is_first or is_last)))"""


# The repeated pass, unrolled; extra rounds change nothing once a round drops nothing.
ROUNDS = 4
cte("fast_1", kept_sql("valid_rows", True))
for number in range(2, ROUNDS + 1):
    cte(f"fast_{number}", kept_sql(f"fast_{number - 1}", True))
cte("fast_rows", f"select * from fast_{ROUNDS}")


def tracks_sql(source: str, keys: str = "mmsi") -> str:
    w = f"(partition by {keys} order by base_datetime, event_id)"
    return f"""select * exclude (brk), cast(cast(mmsi as bigint) * 1000000 + sum(brk) over {w[:-1]}
        rows unbounded preceding) as bigint) as track
      from (select *, case when lag(base_datetime) over {w} is null
        or base_datetime - lag(base_datetime) over {w} > {GAP} then 1 else 0 end as brk from {source})"""


def long_sql(source: str) -> str:
    return f"""select * from {source} where track in (select track from {source} group by track
      having max(base_datetime) - min(base_datetime) > {CFG.min_track})"""


cte("tracked", tracks_sql("valid_rows"))
cte("long_rows", long_sql("tracked"))


def split_sql(source: str) -> str:
    return f"""select r.*, coalesce(v.split, 'test') as split from {source} r left join (
      select track, case when row_number() over (order by md5('{CFG.seed}|' || track), track)
        <= floor(count(*) over () * cast({CFG.validation_fraction} as double)) then 'valid' else 'train' end as split
      from (select track from {source} group by track having min(base_datetime) < {SPLIT_SECOND})) v using (track)"""


cte("split_rows", split_sql("long_rows"))


def between_sql(name: str) -> str:
    return f"case when t = base_datetime then {name} else {name} + (n_{name} - {name}) * ((t - base_datetime) / (nt - base_datetime)) end as {name}"


FIVE = ("lat", "lon", "sog", "cog", "heading")


def resampled_sql(source: str) -> str:
    leads = ", ".join(f"lead({c}) over {WT} as n_{c}" for c in FIVE)
    return f"""select track, t as base_datetime, {", ".join(between_sql(c) for c in FIVE)},
      mmsi_0 as mmsi, group_0 as vessel_group, split_0 as split,
      cast(year(make_timestamp(t * 1000000)) as smallint) as year,
      cast(month(make_timestamp(t * 1000000)) as tinyint) as month,
      (t - t0) // {STEP} as row_index, (t1 - t0) // {STEP} + 1 as row_count
    from (select m.*, g.t from (
        select *, lead(base_datetime) over {WT} as nt, {leads},
          min(base_datetime) over (partition by track) as t0, max(base_datetime) over (partition by track) as t1,
          first_value(mmsi) over {WT} as mmsi_0, first_value(vessel_group) over {WT} as group_0,
          first_value(split) over {WT} as split_0 from {source}) m
      join (select track, unnest(range(min(base_datetime), max(base_datetime) + 1, {STEP})) as t
            from {source} group by track) g
      on g.track = m.track and g.t >= m.base_datetime and g.t < coalesce(m.nt, m.base_datetime + 1))"""


cte("resampled", resampled_sql("split_rows"))


def windows_sql(source: str, length: int, stride: int) -> str:
    return f"""select r.* exclude (row_index, row_count), w.window_id, cast(row_index - w.window_id * {stride} as int) as step
      from {source} r join (
        select track, unnest(range(0, (n - {length}) // {stride} + 1)) as window_id
        from (select track, count(*) as n from {source} group by track having count(*) >= {length})) w
      on w.track = r.track and r.row_index >= w.window_id * {stride} and r.row_index < w.window_id * {stride} + {length}"""


LENGTH = CFG.window_length
cte("test_window_rows", windows_sql("resampled", LENGTH, CFG.history))
cte("train_window_rows", windows_sql("resampled", LENGTH, CFG.train_stride))

cte(
    "current_cells",
    f"""select (i * 13 + 2590) / cast(100 as double) as latitude, (j * 18 - 8558) / cast(100 as double) as longitude,
      t * 10800 + {EPOCH} as time,
      case when not hidden then (a % 401 - 200) / cast(1000 as double) end as water_u,
      case when not hidden then (b % 401 - 200) / cast(1000 as double) end as water_v
    from (select i, j, t, cast(sum(a) as bigint) as a, cast(sum(b) as bigint) as b,
      (i + j) % 9 = 0 or (i * j % 7 = 3 and t % 3 <> 0) as hidden
      from (select l_partkey % 24 as i, l_suppkey % 24 as j, l_orderkey % 40 as t,
        l_partkey * 31 + l_suppkey * 17 + l_orderkey * 13 + l_linenumber * 7 as a,
        l_partkey * 7 + l_suppkey * 43 + l_orderkey * 29 + l_linenumber * 11 as b from lineitem)
      group by i, j, t)""",
)
for variable in ("water_u", "water_v"):
    cte(
        f"long_{variable}",
        f"""select latitude, longitude, {variable} as speed, cast(year(ts) as int) as year, cast(month(ts) as int) as month,
          cast(day(ts) as int) as day, cast(hour(ts) as int) as hour
        from (select *, make_timestamp(time * 1000000) as ts from current_cells)""",
    )
