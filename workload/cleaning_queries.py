"""Cleaning rules, tracks, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.names import snake_case_columns
from keelson.operators import cleaning, tracks
from keelson.plans import clean as plans
from keelson.sources.dims import status_dim, vessel_dim
from workload import inputs
from workload.inputs import CFG
from workload.registry import big, cte, q4, q4_sql, query
from workload.shared_sql import (
    GAP, GOOD_COURSE, GOOD_MMSI, GROUPS, KEPT, REPAIRED, kept_sql, long_sql, moved_sql, speed_sql, tracks_sql,
)

RAW_TEXT = "strftime(make_timestamp(base_datetime * 1000000), '%Y-%m-%dT%H:%M:%S')"


@query(
    "snake_case_columns",
    f"""select mmsi, {RAW_TEXT} as base_datetime, lat, lon, sog, cog, heading, 'VESSEL ' || mmsi as vessel_name,
      'IMO' || mmsi as imo, 'C' || mmsi as call_sign, vessel_type, status, cast(event_id % 300 as double) as length,
      cast(event_id % 40 as double) as width, cast(event_id % 15 as double) as draft,
      cast(event_id % 90 as double) as cargo, case when event_id % 2 = 0 then 'A' else 'B' end as transceiver_class,
      event_id from ais""",
)
def _(spark, sf):
    raw = inputs.raw_messages(spark, sf).withColumnRenamed("TransceiverClass", "TranscieverClass")
    return snake_case_columns(raw)


@query("unknown_heading_to_null", "select event_id, nullif(heading, cast(511 as double)) as heading from ais")
def _(spark, sf):
    return cleaning.null_unknown_heading(inputs.messages(spark, sf)).select("event_id", "heading")


@query("repair_negatives", f"select event_id, {q4_sql('sog')} as sog, {q4_sql('cog')} as cog from (select event_id, {REPAIRED} from ais)")
def _(spark, sf):
    return cleaning.repair_negatives(inputs.messages(spark, sf)).select(
        "event_id", q4(F.col("sog")).alias("sog"), q4(F.col("cog")).alias("cog")
    )


@query("valid_mmsi", f"select event_id, mmsi from ais where {GOOD_MMSI}")
def _(spark, sf):
    return cleaning.filter_valid_mmsi(inputs.messages(spark, sf)).select("event_id", "mmsi")


@query("vessel_group", f"select event_id, mmsi, vessel_group from graded where vessel_group in ({GROUPS})")
def _(spark, sf):
    named = cleaning.assign_vessel_group(inputs.messages(spark, sf), vessel_dim(spark))
    return cleaning.filter_vessel_groups(named, CFG.vessel_groups).select("event_id", "mmsi", "vessel_group")


@query("nav_status", "select event_id, cast(status_code as bigint) as status_code from graded where status_code in (-1, 0, 8)")
def _(spark, sf):
    coded = cleaning.assign_status(inputs.messages(spark, sf), status_dim(spark))
    return cleaning.filter_statuses(coded, CFG.statuses).select("event_id", *big("status_code"))


@query("drop_columns", "select event_id, mmsi, base_datetime, lat, lon, sog, cog, heading from ais")
def _(spark, sf):
    return cleaning.drop_unneeded(inputs.messages(spark, sf))


@query("parse_time_and_sort", "select event_id, mmsi, base_datetime from ais")
def _(spark, sf):
    raw = snake_case_columns(inputs.raw_messages(spark, sf))
    return cleaning.parse_time(raw).select("event_id", "mmsi", "base_datetime")


@query("stationary_filter", f"select {KEPT} from moving where not stationary")
def _(spark, sf):
    return cleaning.drop_stationary(inputs.attribute_filtered(spark, sf), CFG).drop("_chunk")


@query("sog_filter", "select event_id, sog from attr where sog <= 30")
def _(spark, sf):
    return cleaning.filter_sog(inputs.attribute_filtered(spark, sf), CFG.sog_cutoff).select("event_id", "sog")


@query("heading_filter", "select event_id, heading from attr where heading is null or heading between 0 and 360")
def _(spark, sf):
    return cleaning.filter_heading(inputs.attribute_filtered(spark, sf)).select("event_id", "heading")


@query("cog_filter", f"select event_id, {q4_sql('cog')} as cog from attr where cog between 0 and 360")
def _(spark, sf):
    return cleaning.filter_cog(inputs.attribute_filtered(spark, sf)).select("event_id", q4(F.col("cog")).alias("cog"))


def _knots_sql(name):
    return f"case when isinf({name}) then {name} else {q4_sql(name)} end as {name}"


def _knots(name):
    infinite = F.col(name) == float("inf")
    return F.when(infinite, F.col(name)).otherwise(q4(F.when(~infinite, F.col(name)))).alias(name)


cte("speeds", speed_sql("valid_rows"))


@query(
    "empirical_speed",
    f"select event_id, {_knots_sql('prev_knots')}, {_knots_sql('next_knots')}, is_first, is_last from speeds",
)
def _(spark, sf):
    out = cleaning.with_empirical_speed(inputs.valid(spark, sf), CFG)
    return out.select("event_id", _knots("prev_knots"), _knots("next_knots"), "is_first", "is_last")


@query(
    "haversine",
    f"""select event_id, {q4_sql('prev_knots * (base_datetime - pt) / 3600')} as prev_nm from (
      select s.*, lag(base_datetime) over (partition by mmsi order by base_datetime, event_id) as pt from speeds s)
      where prev_knots is not null and not isinf(prev_knots)""",
)
def _(spark, sf):
    from keelson.functions.geo import haversine
    from keelson.functions.ordered import with_chunk, with_neighbours

    near = with_neighbours(with_chunk(inputs.valid(spark, sf)), ["mmsi"], cleaning.ORDER, ["base_datetime", "lat", "lon"], ["prev"])
    prev = F.col("_prev")
    moved_in_time = near.where(prev.isNotNull() & (prev["base_datetime"] != F.col("base_datetime")))
    return moved_in_time.select("event_id", q4(haversine(F.col("lat"), F.col("lon"), prev["lat"], prev["lon"], "nm")).alias("prev_nm"))


cte("partial_1", kept_sql("valid_rows", False))


@query("speed_outlier_once", "select event_id, mmsi, base_datetime from fast_1")
def _(spark, sf):
    return cleaning.speed_outlier_pass(inputs.valid(spark, sf), CFG).select("event_id", "mmsi", "base_datetime")


@query("speed_outlier_once_partial", "select event_id, mmsi, base_datetime from partial_1")
def _(spark, sf):
    out = cleaning.speed_outlier_pass(inputs.valid(spark, sf), CFG, complete=False)
    return out.select("event_id", "mmsi", "base_datetime")


@query("speed_outlier_fixpoint", f"select {KEPT} from fast_rows")
def _(spark, sf):
    return cleaning.speed_outliers(inputs.valid(spark, sf), CFG).drop("_chunk")


@query(
    "narrow_types",
    """select event_id, cast(base_datetime as double) as base_datetime, cast(lat as float) as lat, cast(lon as float) as lon,
      cast(trunc(lat * 1000) as smallint) as water_u from ais""",
)
def _(spark, sf):
    rows = inputs.messages(spark, sf).withColumn("water_u", F.col("lat") * 1000)
    out = cleaning.narrow_types(rows.select("event_id", "base_datetime", "lat", "lon", "water_u"))
    return out.withColumn("event_id", F.col("event_id").cast("bigint"))


@query("track_id", "select event_id, mmsi, base_datetime, track from tracked")
def _(spark, sf):
    return tracks.assign_tracks(inputs.valid(spark, sf), CFG).select("event_id", "mmsi", "base_datetime", "track")


@query("long_tracks", "select event_id, track, base_datetime from long_rows")
def _(spark, sf):
    return inputs.long_tracks(spark, sf).select("event_id", "track", "base_datetime")


def periods(df):
    """Ten-day periods with their bounds, standing in for the source's monthly files."""
    number = F.floor((F.col("base_datetime") - inputs.EPOCH) / 864_000)
    bounded = df.withColumn("period", number)
    start = F.col("period") * 864_000 + inputs.EPOCH
    return bounded.withColumns({"min_time": start, "max_time": start + 863_999})


def period_tracks_sql(source):
    return tracks_sql(source, "period, mmsi")


def open_tracks_sql(source):
    return f"""select r.* from {source} r join (select period, track,
        max(base_datetime) - min(base_datetime) > {CFG.min_track}
        or min(base_datetime) - (period * 864000 + {inputs.EPOCH}) <= {GAP}
        or (period * 864000 + {inputs.EPOCH} + 863999) - max(base_datetime) <= {GAP} as keep
      from {source} group by period, track) k using (period, track) where keep"""


PERIOD = f"(base_datetime - {inputs.EPOCH}) // 864000 as period"
cte("valid_period", f"select *, {PERIOD} from valid_rows")
cte("period_tracked", period_tracks_sql("valid_period"))
cte("period_open", open_tracks_sql("period_tracked"))


@query("long_or_unknown_tracks", "select event_id, period, track, base_datetime from period_open")
def _(spark, sf):
    rows = tracks.assign_tracks(periods(inputs.valid(spark, sf).drop("_chunk")), CFG, ("period", "mmsi"))
    return tracks.filter_short_tracks_in_period(rows, CFG).select("event_id", "period", "track", "base_datetime")


@query(
    "temporal_split",
    """select o_orderkey, case when (year(o_orderdate) - 1992) * 12 + month(o_orderdate) - 1 >= 84 - 16 then 'test' else 'train' end as split
      from orders""",
)
def _(spark, sf):
    from keelson.functions.clock import seconds_of

    orders = inputs.table(spark, sf, "orders").select(
        "o_orderkey", seconds_of(F.col("o_orderdate")).alias("base_datetime")
    )
    return tracks.temporal_split(orders, range(1992, 1999), 0.2).drop("base_datetime")


@query("track_split", "select event_id, track, split from split_rows")
def _(spark, sf):
    return inputs.split_tracks(spark, sf).select("event_id", "track", "split")


cte("clean_tracked", tracks_sql("fast_rows"))
cte("clean_rows", long_sql("clean_tracked"))


@query("clean_partition", "select event_id, mmsi, base_datetime, track from clean_rows")
def _(spark, sf):
    return plans.clean_tracks(inputs.attribute_filtered(spark, sf), CFG).select("event_id", "mmsi", "base_datetime", "track")


# First pass per period: every rule applied inside (period, ship), partial speed rule.
cte("p_attr", f"select *, {PERIOD} from attr")
cte("p_moving", moved_sql("p_attr").replace("partition by mmsi", "partition by period, mmsi"))
cte("p_valid", f"select {KEPT}, period from p_moving where not stationary and {GOOD_COURSE}")
cte("p_fast_1", kept_sql("p_valid", False, "period, mmsi"))
cte("p_fast_2", kept_sql("p_fast_1", False, "period, mmsi"))
cte("p_fast_3", kept_sql("p_fast_2", False, "period, mmsi"))
cte("p_tracked", period_tracks_sql("p_fast_3"))
cte("p_clean", open_tracks_sql("p_tracked"))


def _period_input(spark, sf):
    return periods(inputs.messages(spark, sf))


@query("clean_period", "select event_id, mmsi, base_datetime, period, vessel_group from p_clean")
def _(spark, sf):
    return plans.clean_period(_period_input(spark, sf), CFG, vessel_dim(spark), status_dim(spark)).select(
        "event_id", "mmsi", "base_datetime", "period", "vessel_group"
    )


# Both passes: the period pass, a split by time, then the full rules inside each split.
cte("c_timed", f"select *, base_datetime >= {inputs.SPLIT_SECOND} as is_test from p_clean")
cte("c_moving", moved_sql("(select * exclude (track) from c_timed)").replace("partition by mmsi", "partition by is_test, mmsi"))
cte("c_valid", f"select {KEPT}, is_test from c_moving where not stationary and {GOOD_COURSE}")
cte("c_fast_1", kept_sql("c_valid", True, "is_test, mmsi"))
cte("c_fast_2", kept_sql("c_fast_1", True, "is_test, mmsi"))
cte("c_fast_3", kept_sql("c_fast_2", True, "is_test, mmsi"))
cte("c_tracked", tracks_sql("c_fast_3", "is_test, mmsi"))
cte(
    "c_long",
    f"""select t.* from c_tracked t join (select is_test, track from c_tracked group by is_test, track
      having max(base_datetime) - min(base_datetime) > {CFG.min_track}) k using (is_test, track)""",
)
cte(
    "c_split",
    f"""select r.*, case when is_test then 'test' else v.split end as split from c_long r left join (
      select track, case when row_number() over (order by md5('{CFG.seed}|' || track), track)
        <= floor(count(*) over () * cast({CFG.validation_fraction} as double)) then 'valid' else 'train' end as split
      from (select distinct track from c_long where not is_test)) v using (track)""",
)


@query("clean_splits", "select event_id, mmsi, base_datetime, track, split from c_split")
def _(spark, sf):
    test = F.col("base_datetime") >= inputs.SPLIT_SECOND
    out = plans.clean(_period_input(spark, sf), CFG, vessel_dim(spark), status_dim(spark), test)
    return out.select("event_id", "mmsi", "base_datetime", "track", "split")


_AUDIT = f"""
  select 1 as step, 'invalid mmsi' as reason, count(*) filter (not good_mmsi) as dropped, count(*) as before from graded
  union all select 2, 'vessel type', count(*) filter (vessel_group not in ({GROUPS})), count(*) from graded where good_mmsi
  union all select 3, 'status', count(*) filter (coalesce(status_code not in (-1, 0, 8), true)), count(*)
    from graded where good_mmsi and vessel_group in ({GROUPS})
  union all select 4, 'stationary', count(*) filter (stationary), count(*) from moving
  union all select 5, 'sog cog heading', count(*) filter (not ({GOOD_COURSE})), count(*) from moving where not stationary
  union all select 6, 'empirical speed', (select count(*) from valid_rows) - (select count(*) from fast_rows), (select count(*) from valid_rows)
  union all select 7, 'short track', (select count(*) from fast_rows) - (select count(*) from clean_rows), (select count(*) from fast_rows)"""


@query(
    "drop_audit",
    f"""select cast(step as bigint) as step, reason, cast(dropped as bigint) as dropped, cast(before - dropped as bigint) as remaining,
      {q4_sql('case when before > 0 then dropped * 100 / cast(before as double) end')} as percent from ({_AUDIT})""",
)
def _(spark, sf):
    audit = plans.clean_audit(inputs.messages(spark, sf), CFG, vessel_dim(spark), status_dim(spark))
    return audit.select(*big("step"), "reason", *big("dropped", "remaining"), q4(F.col("percent")).alias("percent"))
