"""Resampling, sliding windows, one-hot columns, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import resample, windows
from workload import inputs
from workload.inputs import CFG
from workload.registry import big, cte, q4, q4_sql, query
from workload.shared_sql import FIVE, WT, resampled_sql


@query(
    "resample_grid",
    f"""select track, unnest(range(min(base_datetime), max(base_datetime) + 1, {CFG.step})) as base_datetime
      from long_rows group by track""",
)
def _(spark, sf):
    return resample.resample_grid(inputs.long_tracks(spark, sf), CFG)


cte("long_resampled", resampled_sql("(select *, 'all' as split from long_rows)"))


@query("linear_interpolate", f"select track, base_datetime, {', '.join(f'{q4_sql(c)} as {c}' for c in FIVE)} from long_resampled")
def _(spark, sf):
    out = resample.interpolate(inputs.long_tracks(spark, sf), CFG)
    return out.select("track", "base_datetime", *[q4(F.col(c)).alias(c) for c in FIVE])


@query(
    "previous_value",
    f"""select g.track, g.t as base_datetime, m.event_id as last_event from (
        select track, unnest(range(min(base_datetime), max(base_datetime) + 1, {CFG.step})) as t from long_rows group by track) g
      join (select *, lead(base_datetime) over {WT} as nt from long_rows) m
        on m.track = g.track and g.t >= m.base_datetime and g.t < coalesce(m.nt, m.base_datetime + 1)""",
)
def _(spark, sf):
    rows = inputs.long_tracks(spark, sf).withColumn("last_event", F.col("event_id"))
    out = resample.interpolate(rows, CFG, linear=(), previous=("last_event",))
    return out.select("track", "base_datetime", "last_event")


@query("stable_value", "select track, base_datetime, mmsi, vessel_group from long_resampled")
def _(spark, sf):
    out = resample.interpolate(inputs.long_tracks(spark, sf), CFG, linear=(), stable=("mmsi", "vessel_group"))
    return out.select("track", "base_datetime", "mmsi", "vessel_group")


@query("calendar_columns", "select track, base_datetime, cast(year as bigint) as year, cast(month as bigint) as month from long_resampled")
def _(spark, sf):
    out = resample.interpolate(inputs.long_tracks(spark, sf), CFG, linear=())
    return out.select("track", "base_datetime", *big("year", "month"))


GRID = f"""track, base_datetime, {', '.join(f'{q4_sql(c)} as {c}' for c in FIVE)}, mmsi, vessel_group, split,
  cast(year as bigint) as year, cast(month as bigint) as month"""
GRID_COLUMNS = ["mmsi", "vessel_group", "split"]


@query("interpolate_tracks", f"select {GRID} from resampled")
def _(spark, sf):
    return inputs.resampled(spark, sf).select(
        "track", "base_datetime", *[q4(F.col(c)).alias(c) for c in FIVE], *GRID_COLUMNS, *big("year", "month")
    )


WINDOW = f"track, cast(window_id as bigint) as window_id, cast(step as bigint) as step, base_datetime, {q4_sql('lat')} as lat"


def window_columns():
    return ["track", *big("window_id", "step"), "base_datetime", q4(F.col("lat")).alias("lat")]


@query("sliding_test", f"select {WINDOW} from test_window_rows")
def _(spark, sf):
    # Without the row positions resampling leaves behind, they are counted anew.
    rows = inputs.resampled(spark, sf).drop("row_index", "row_count")
    return windows.test_windows(rows, CFG).select(*window_columns())


@query("sliding_train", f"select {WINDOW} from train_window_rows")
def _(spark, sf):
    return windows.train_windows(inputs.resampled(spark, sf), CFG).select(*window_columns())


@query("window_datasets", f"select dataset, {WINDOW} from dataset_rows")
def _(spark, sf):
    return windows.window_datasets(inputs.resampled(spark, sf), CFG).select("dataset", *window_columns())


_LEVELS = sorted(["cargo", "passenger", "fishing", "tug tow", "tanker", "pleasure craft or sailing"])
_HOT = ", ".join(
    f"""vessel_group = '{level}' and '{level}' in (select vessel_group from resampled where split = 'train') as "vessel_group_{level}" """
    for level in _LEVELS
)


@query("one_hot", f"select track, base_datetime, {_HOT} from resampled")
def _(spark, sf):
    rows = inputs.resampled(spark, sf)
    levels = windows.learn_levels(rows.where(F.col("split") == "train"), ["vessel_group"])
    return windows.one_hot(rows, levels).select("track", "base_datetime", *[f"vessel_group_{v}" for v in levels["vessel_group"]])


@query(
    "reshape_sequences",
    f"""select track, cast(window_id as bigint) as window_id, cast(step as bigint) as step, {q4_sql('lat')} as lat, {q4_sql('sog')} as sog
      from test_window_rows""",
)
def _(spark, sf):
    rows = inputs.resampled(spark, sf).withColumn("sequence", F.array("lat", "lon", "sog"))
    sequences = windows.windows_of(windows.window_blocks(rows, CFG, ["sequence"]), CFG, (windows.Cut("test", CFG.history),))
    rows = sequences.select("track", "window_id", F.posexplode("sequence").alias("step", "row"))
    return rows.select("track", *big("window_id", "step"), q4(F.col("row")[0]).alias("lat"), q4(F.col("row")[2]).alias("sog"))


@query("select_x_steps", f"select {WINDOW} from test_window_rows where step in (0, 2, 4)")
def _(spark, sf):
    rows = windows.test_windows(inputs.resampled(spark, sf), CFG)
    return windows.select_x_steps(rows, CFG, 7200).select(*window_columns())


@query("select_y_steps", f"select {WINDOW} from test_window_rows where step in (6, 8)")
def _(spark, sf):
    rows = windows.test_windows(inputs.resampled(spark, sf), CFG)
    return windows.select_y_steps(rows, CFG, 7200).select(*window_columns())
