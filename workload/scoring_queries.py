"""Scoring and evaluation, with the persistence predictor as the model."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from keelson.functions.ordered import CHUNK, with_position
from keelson.functions.storage import cut, work_folder
from keelson.operators import features as fx
from keelson.operators import scoring, windows
from keelson.operators import window_features as wf
from keelson.sources.sinks import save_predictions
from workload import inputs
from workload.inputs import CFG
from workload.feature_queries import GAP, KEY_SQL, LOCAL, WK, key
from workload.registry import big, cte, haversine_sql, q4, q4_sql, query

# Truth: every future step; prediction: the last history position, repeated.
cte(
    "errors",
    f"""select y.track, y.window_id, y.step, y.step - 5 as step_index, y.split, y.lat as true_lat, y.lon as true_lon, x.lat as pred_lat, x.lon as pred_lon,
      {haversine_sql('y.lat', 'y.lon', 'x.lat', 'x.lon')} as error_km
      from test_window_rows y join test_window_rows x on x.track = y.track and x.window_id = y.window_id and x.step = 4 where y.step >= 5""",
)


ALL_SPLITS = (windows.Cut("test", CFG.history, ("train", "valid", "test")),)
FUTURE = list(range(CFG.history, CFG.window_length))


def whole_windows(spark, sf, columns):
    """Every test window as one row: its history steps as arrays, its future as ``true``, its split."""
    rows = fx.with_local_time(inputs.resampled(spark, sf))
    whole = windows.windows_of(windows.window_blocks(rows, CFG, columns), CFG, ALL_SPLITS)
    true = F.arrays_zip(*[windows.at_steps(F.col(c), FUTURE).alias(c) for c in ("lat", "lon")])
    histories = {c: windows.at_steps(F.col(c), windows.x_steps(CFG, GAP)) for c in columns}
    return whole.withColumn("true", true).withColumns(histories).withColumn("split", F.substring_index("dataset", "_", 1))


def errors(spark, sf):
    """Errors of the persistence prediction at every future step, from one pass over the windows."""
    whole = whole_windows(spark, sf, ["lat", "lon"])
    stays = F.array_repeat(F.struct(F.element_at("lat", -1).alias("lat"), F.element_at("lon", -1).alias("lon")), len(FUTURE))
    out = scoring.step_errors(whole.withColumn("predicted", stays), [*scoring.KEY, "split"])
    return out.withColumn("step", F.col("step_index") + CFG.history)


@query("haversine_error", f"select {KEY_SQL}, cast(step as bigint) as step, {q4_sql('error_km')} as error_km from errors")
def _(spark, sf):
    return errors(spark, sf).select(*key(), q4(F.col("error_km")).alias("error_km"))


@query(
    "horizon_errors",
    f"""select cast(step_index + 1 as bigint) as hour, {q4_sql('avg(error_km)')} as mean_km, count(*) as n from errors
      where step_index <= 2 group by step_index""",
)
def _(spark, sf):
    out = scoring.horizon_errors(errors(spark, sf), 60)
    return out.select(*big("hour"), q4(F.col("mean_km")).alias("mean_km"), *big("n"))


@query(
    "haversine_loss",
    f"""select 'haversine' as metric, {q4_sql(f"avg({haversine_sql('true_lat', 'true_lon', 'pred_lat', 'pred_lon', '6371')})")} as loss from errors
      union all select 'mse', {q4_sql('avg((pow(true_lat - pred_lat, 2) + pow(true_lon - pred_lon, 2)) / 2)')} from errors""",
)
def _(spark, sf):
    both = cut(errors(spark, sf))
    parts = [
        scoring.mean_error(both, m).select(F.lit(m).alias("metric"), q4(F.col("loss")).alias("loss")) for m in ("haversine", "mse")
    ]
    return parts[0].unionByName(parts[1])


_STATE = ["lat", "lon", "hour", "day_of_week", "distance_traveled"]


def states(spark, sf):
    whole = whole_windows(spark, sf, ["lat", "lon", "hour", "day_of_week"])
    known = wf.with_window_distance(whole).withColumn("distance_traveled", F.array_repeat("distance_traveled", F.size("lat")))
    return known.withColumn("state", F.arrays_zip(*_STATE)).withColumn("sequence", F.transform("state", lambda s: F.array(*[s[c].cast("double") for c in _STATE])))


# The new step: last position moved by a thousandth, the clock advanced, the distance from step 1.
cte(
    "clocked",
    f"select *, hour({LOCAL}) as hour, isodow({LOCAL}) - 1 as day_of_week, lag(hour({LOCAL})) over (partition by track, window_id order by step) as hour_before from distance_rows",
)
cte(
    "advanced",
    f"""select track, window_id, lat + cast(0.001 as double) as lat, lon, (hour + more) % 24 as hour,
        (day_of_week + case when hour + more > 23 then 1 else 0 end) % 7 as day_of_week,
        {haversine_sql('lat_s', 'lon_s', '(lat + cast(0.001 as double))', 'lon')} as distance_traveled
      from (select *, case when changed + 1 < 5 then 1 else 0 end as more from (
        select *, coalesce(max(case when hour <> hour_before then step - 1 end) over {WK}, -1) as changed,
          max(case when step = 1 then lat end) over {WK} as lat_s, max(case when step = 1 then lon end) over {WK} as lon_s from clocked)) where step = 4""",
)


@query(
    "rollout_state",
    f"""select {KEY_SQL}, cast(step - 1 as bigint) as at, {q4_sql('lat')} as lat, cast(hour as bigint) as hour, cast(day_of_week as bigint) as day_of_week,
        {q4_sql('distance_traveled')} as distance_traveled from clocked where step >= 1
      union all select {KEY_SQL}, 4, {q4_sql('lat')}, cast(hour as bigint), cast(day_of_week as bigint), {q4_sql('distance_traveled')} from advanced""",
)
def _(spark, sf):
    rows = states(spark, sf)
    last = F.element_at(F.col("state"), -1)
    moved = scoring.advance_state(rows, {"lat": last["lat"] + 0.001, "lon": last["lon"]}, 60)
    steps = moved.select("track", "window_id", F.posexplode("state").alias("at", "s"))
    return steps.select(
        "track", *big("window_id", "at"), q4(F.col("s.lat")).alias("lat"), F.col("s.hour").cast("bigint").alias("hour"),
        F.col("s.day_of_week").cast("bigint").alias("day_of_week"), q4(F.col("s.distance_traveled")).alias("distance_traveled"),
    )


def last_position(sequences: pd.Series) -> pd.DataFrame:
    """A model for :func:`keelson.operators.scoring.score`: the last position of each sequence."""
    return pd.DataFrame([[s[-1][0], s[-1][1]] for s in sequences])


@query("batch_score", f"select {KEY_SQL}, {q4_sql('lat')} as pred_lat, {q4_sql('lon')} as pred_lon from history_rows where step = 4")
def _(spark, sf):
    out = scoring.score(states(spark, sf), last_position)
    return out.select(*key(False), q4(F.col("pred_lat")).alias("pred_lat"), q4(F.col("pred_lon")).alias("pred_lon"))


def straight_on(sequences: np.ndarray) -> np.ndarray:
    """A model of all future steps at once: the last hop, repeated."""
    last, hop = sequences[:, -1, :2], sequences[:, -1, :2] - sequences[:, -2, :2]
    return last[:, None, :] + hop[:, None, :] * np.arange(1, len(FUTURE) + 1)[None, :, None]


@query(
    "iterative_rollout",
    f"select {KEY_SQL}, cast(step - 5 as bigint) as step_index, {q4_sql('pred_lat')} as pred_lat, {q4_sql('pred_lon')} as pred_lon from errors",
)
def _(spark, sf):
    feedback = scoring.Feedback(tuple(_STATE), gap_minutes=60)
    ahead = scoring.fed_back(lambda sequences: sequences[:, -1, :2], len(FUTURE), feedback)
    out = scoring.predicted_steps(scoring.with_predictions(states(spark, sf), ahead))
    return out.select(*key(False), *big("step_index"), q4(F.col("pred_lat")).alias("pred_lat"), q4(F.col("pred_lon")).alias("pred_lon"))


@query(
    "multi_step_score",
    f"""select {KEY_SQL}, cast(step_index as bigint) as step_index, {q4_sql('pred_lat')} as pred_lat, {q4_sql('pred_lon')} as pred_lon,
      {q4_sql(haversine_sql('true_lat', 'true_lon', 'pred_lat', 'pred_lon'))} as error_km
      from (select y.track, y.window_id, y.step - 5 as step_index, y.lat as true_lat, y.lon as true_lon,
          b.lat + (b.lat - a.lat) * (y.step - 4) as pred_lat, b.lon + (b.lon - a.lon) * (y.step - 4) as pred_lon
        from test_window_rows y join history_rows a on a.track = y.track and a.window_id = y.window_id and a.step = 3
          join history_rows b on b.track = y.track and b.window_id = y.window_id and b.step = 4 where y.step >= 5)""",
)
def _(spark, sf):
    out = scoring.step_errors(scoring.with_predictions(states(spark, sf), straight_on))
    return out.select(*key(False), *big("step_index"), *[q4(F.col(c)).alias(c) for c in ("pred_lat", "pred_lon", "error_km")])


def by_hour(spark, sf):
    return errors(spark, sf).where(F.col("step_index") <= 2).withColumn("hour", F.col("step_index") + 1)


@query(
    "save_predictions",
    f"""select {KEY_SQL}, split, cast(step_index + 1 as bigint) as hour, {q4_sql('pred_lat')} as pred_lat, {q4_sql('pred_lon')} as pred_lon,
      {q4_sql('error_km')} as error_km from errors where step_index <= 2""",
)
def _(spark, sf):
    columns = [*scoring.KEY, "split", "hour", "pred_lat", "pred_lon", "error_km"]
    saved = save_predictions(by_hour(spark, sf).select(*columns), work_folder(spark, "predictions"))
    return saved.select(*key(False), "split", *big("hour"), *[q4(F.col(c)).alias(c) for c in ("pred_lat", "pred_lon", "error_km")])


cte(
    "losses",
    """select o_custkey % 20 as run, (o_custkey % 20) % 2 as experiment_id, o_totalprice / cast(100000 as double) as loss,
      row_number() over (partition by o_custkey % 20 order by o_orderkey) as steps from orders""",
)
cte("run_means", "select *, avg(loss) over (partition by run order by steps) as average_loss from losses")
cte("cutoffs", "select experiment_id, steps, median(average_loss) as average_loss from run_means group by experiment_id, steps")


def losses(spark, sf):
    orders = inputs.table(spark, sf, "orders").select(
        (F.col("o_custkey") % 20).alias("run"), "o_orderkey", (F.col("o_totalprice") / 100000).alias("loss")
    )
    placed = with_position(orders.withColumn(CHUNK, F.floor(F.col("o_orderkey") / 65_536)), ["run"], ["o_orderkey"])
    return placed.select("run", (F.col("run") % 2).alias("experiment_id"), "loss", (F.col("row_index") + 1).alias("steps"))


@query(
    "median_stopping_cutoffs",
    f"select experiment_id, cast(steps as bigint) as steps, {q4_sql('average_loss')} as average_loss from cutoffs",
)
def _(spark, sf):
    out = scoring.median_cutoffs(losses(spark, sf))
    return out.select("experiment_id", *big("steps"), q4(F.col("average_loss")).alias("average_loss"))


@query(
    "median_stopping_decision",
    f"""select run, b.experiment_id, cast(b.steps as bigint) as steps, {q4_sql('best_loss')} as best_loss, coalesce(best_loss > c.average_loss, false) as stop
      from (select *, min(loss) over (partition by run order by steps) as best_loss from losses) b
      left join cutoffs c on c.experiment_id = b.experiment_id and c.steps = b.steps where b.steps % 30 = 0""",
)
def _(spark, sf):
    metrics = losses(spark, sf)
    out = scoring.stopping_decisions(metrics, scoring.median_cutoffs(metrics))
    return out.select("run", "experiment_id", *big("steps"), q4(F.col("best_loss")).alias("best_loss"), "stop")


@query(
    "metrics_summary",
    f"select split, cast(step_index + 1 as bigint) as hour, {q4_sql('avg(error_km)')} as mean_km, count(*) as n from errors where step_index <= 2 group by split, step_index",
)
def _(spark, sf):
    out = scoring.evaluation_summary(by_hour(spark, sf))
    return out.select("split", *big("hour"), q4(F.col("mean_km")).alias("mean_km"), *big("n"))
