"""Hand-worked cases of resampling, windows, features and scoring."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.config import Box, Config
from keelson.functions.geo import great_circle_km
from keelson.operators import currents, features, nearest, resample, scoring, windows
from keelson.operators import window_features as wf
from keelson.plans import features as plans

CFG = Config()


def one_track(spark, rows):
    data = [(i, 1, t, lat, heading) for i, (t, lat, heading) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id bigint, track bigint, base_datetime bigint, lat double, heading double")


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_interpolation_between_messages(spark, hot_rows):
    rows = one_track(spark, [(0, 0.0, 1.0), (400, 4.0, None), (900, 9.0, 5.0)])
    out = resample.interpolate(rows, replace(CFG, hot_rows=hot_rows), ("lat", "heading")).orderBy("base_datetime").collect()
    assert [(r["base_datetime"], round(r["lat"], 9), r["heading"]) for r in out] == [
        (0, 0, 1.0), (300, 3, None), (600, 6, None), (900, 9, 5.0)
    ]
    assert [(r["row_index"], r["row_count"]) for r in out] == [(0, 4), (1, 4), (2, 4), (3, 4)]


def test_last_of_two_messages_at_one_time_wins(spark):
    rows = one_track(spark, [(0, 0.0, None), (300, 1.0, None), (300, 2.0, None), (600, 4.0, None)])
    out = resample.interpolate(rows, CFG, ("lat",)).orderBy("base_datetime").collect()
    assert [r["lat"] for r in out] == [0.0, 2.0, 4.0]


@pytest.mark.parametrize("n,stride,starts", [(73, 37, [0]), (110, 37, [0, 37]), (72, 37, []), (80, 3, [0, 3, 6])])
def test_window_starts(spark, n, stride, starts):
    rows = spark.range(n).select(F.lit(1).alias("track"), (F.col("id") * 300).alias("base_datetime"))
    out = windows.sliding_windows(rows, 73, stride)
    got = out.groupBy("window_id").agg(F.min("base_datetime"), F.count(F.lit(1)), F.max("step")).orderBy("window_id")
    assert [tuple(r)[1:] for r in got.collect()] == [(s * 300, 73, 72) for s in starts]


def test_kept_steps():
    assert windows.x_steps(CFG, 1800) == [0, 6, 12, 18, 24, 30, 36]
    assert windows.y_steps(CFG, 1800) == [42, 48, 54, 60, 66, 72]
    assert len(windows.x_steps(CFG, 900)) == 13
    assert windows.y_steps(CFG, 900) == list(range(39, 73, 3))
    assert [features.target_index(CFG, h, 1800) for h in (1, 2, 3)] == [1, 3, 5]
    assert [features.target_index(CFG, h, 900) for h in (1, 2, 3)] == [3, 7, 11]


def test_bearings(spark):
    df = spark.createDataFrame([([0.0, 0.0, 1.0, 1.0], [0.0, 1.0, 1.0, 0.0])], "lat array<double>, lon array<double>")
    row = wf.with_window_bearings(df).first()
    assert row["mean_bearing_angle"] == pytest.approx((90 + 0 + 270) / 3, abs=0.01)


def test_window_stats_leave_nulls_out(spark):
    df = spark.createDataFrame([([3.0, None, 1.0, 2.0, 10.0],), ([None, None, None, None, None],), ([None, 5.0, 4.0, None, None],)], "sog array<double>")
    rows = [tuple(r) for r in wf.with_window_stats(df, ["sog"]).select("sog_min", "sog_median", "sog_max").collect()]
    assert rows == [(1.0, 2.5, 10.0), (None, None, None), (4.0, 4.5, 5.0)]
    some = wf.with_window_stats(df, ["sog"], "median", steps=[0, 2, 4]).select("sog_median").collect()
    assert [r[0] for r in some] == [3.0, None, 4.0]


def test_bins(spark):
    df = spark.createDataFrame([(3.9, -10.0), (16.0, 61.0)], "sog double, cog double")
    out = features.with_bins(df, features.BINS[:2]).collect()
    assert [(r["sog_bin"], r["cog_bin"]) for r in out] == [("[0, 4)", "[-60, 0)"), ("[16+]", "[60, 120)")]


def test_normalization_round_trip(spark):
    df = spark.createDataFrame([(26.5, 7.0, 1.0), (28.0, 7.0, 3.0)], "lat double, sog double, cog double")
    fitted = features.fit_normalizer(df, Box(26, 29, -85.5, -81.5), (2015, 2019), ["lat", "sog", "cog"])
    ranges = features.factors(fitted)
    scaled = features.normalize(df, ranges)
    assert [r["sog"] for r in scaled.collect()] == [0.0, 0.0]
    back = features.unnormalize(scaled, ranges).collect()
    assert [tuple(r) for r in back] == [pytest.approx(tuple(r)) for r in df.collect()]


def test_one_hot_round_trip(spark):
    df = spark.createDataFrame([(1, "cargo"), (2, "tug tow")], "id int, vessel_group string")
    hot = windows.one_hot(df, windows.learn_levels(df, ["vessel_group"]))
    assert sorted(map(tuple, features.undo_one_hot(hot, "vessel_group").collect())) == [(1, "cargo"), (2, "tug tow")]


@pytest.mark.parametrize("n,kept", [(38, 13), (51, 13), (32, 16)])
def test_thinning_stride(spark, n, kept):
    rows = spark.range(n).select(
        F.col("id").cast("double").alias("latitude"), F.lit(1.0).alias("longitude"), F.lit(1.0).alias("speed")
    )
    assert currents.thin_grid(rows).count() == kept


def test_weather_grid_masks(spark):
    cell = "array(named_struct('lat', 1D, 'lon', 10D, 'u', 3S, 'v', 4S))"
    df = spark.range(2).selectExpr("id", f"{cell} as currents", "id = 1 as weather_is_imputed")
    frame = spark.sql("select array(2D, 1D) as lats, array(10D) as lons")
    out = features.weather_grid(df, frame).orderBy("id").collect()
    assert out[0]["grid"] == [[[3.0, 4.0, 0.0], [0.5, 0.5, 1.0]]]
    assert out[1]["grid"] == [[[3.0, 4.0, 0.5], [0.5, 0.5, 1.0]]]


def test_median_stopping(spark):
    data = [("a", 0, 1, 4.0), ("a", 0, 2, 2.0), ("b", 0, 1, 2.0), ("b", 0, 2, 2.0)]
    metrics = spark.createDataFrame(data, "run string, experiment_id int, steps long, loss double")
    cutoffs = scoring.median_cutoffs(metrics)
    assert sorted(tuple(r)[1:] for r in cutoffs.collect()) == [(1, 3.0), (2, 2.5)]
    stops = scoring.stopping_decisions(metrics, cutoffs, every=1).where("stop").select("run", "steps").collect()
    assert [tuple(r) for r in stops] == [("a", 1)]


def test_state_advances_hour_and_day(spark):
    state = ", ".join(f"named_struct('lat', {i}D, 'lon', 0D, 'hour', {h}, 'day_of_week', 6, 'distance_traveled', 0D)" for i, h in enumerate((22, 23, 23)))
    df = spark.sql(f"select 1L as track, 0L as window_id, array({state}) as state")
    out = scoring.advance_state(df, {"lat": F.lit(5.0), "lon": F.lit(0.0)}, 30).first()["state"]
    # The hour changed after step 0; two half-hour steps later the next one is due.
    assert [s["hour"] for s in out] == [23, 23, 0]
    assert out[-1]["day_of_week"] == 0
    assert out[-1]["distance_traveled"] == pytest.approx(4 * 111.195, rel=1e-3)


def test_gathered_windows_are_the_exploded_ones_after_one_shuffle(spark):
    cfg = replace(CFG, history=4, future=3, step=300, window_movement=900)
    rows = []
    for track, (n, split) in enumerate([(7, "train"), (8, "valid"), (300, "valid"), (129, "train"), (130, "test")]):
        rows += [(track, split, i, n, 300 * i, float(i), float(track)) for i in range(n)]
    df = spark.createDataFrame(rows, "track long, split string, row_index long, row_count long, base_datetime long, lat double, lon double")
    got = windows.gathered_windows(df, cfg, ["lat", "lon"])
    want = windows.to_sequences(windows.window_datasets(df, cfg), ["lat", "lon"], ("dataset", "track", "window_id"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    text = windows.tensor_parts(df, replace(cfg, time_gaps=(300, 600)), ["lat"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_plan_shapes_all_parts_of_every_dataset_in_one_pass(spark):
    cfg = replace(CFG, history=3, future=2, step=3600, window_movement=3600, years=(2024,))
    rows = [(track, split, i, 9, 3600 * i, 27 + track / 10, -84 + i / 10, float(i), float(track), 2024, 1) for track, split in enumerate(("train", "valid", "test")) for i in range(9)]
    df = spark.createDataFrame(rows, "track long, split string, row_index long, row_count long, base_datetime long, lat double, lon double, sog double, cog double, year int, month int")
    run = plans.Run(gap=3600, history_hours=1, hours_out=2, model="iterative", sog_cog="raw")
    whole = windows.windows_of(plans.blocks_for(df, run, cfg), cfg, windows.dataset_cuts(cfg))
    ranges = plans.fit_ranges(whole, run, cfg, Box(26, 29, -85.5, -81.5))
    assert ranges["sog"] == (1.0, 5.0)
    shaped = plans.shape(whole, run, cfg, ranges)
    counts = {}
    for r in shaped.groupBy("part", "dataset").count().collect():
        counts.setdefault(r["part"], {})[r["dataset"]] = r["count"]
    windows_of = {"train_long_term_train": 4, "valid_long_term_train": 4, "valid_long_term_test": 2, "test_long_term_test": 2}
    assert counts["x"] == counts["recurrent"] == {name: 2 * n for name, n in windows_of.items()}
    assert counts["dense"] == windows_of
    assert counts["y"] == {name: n * (3 if name.endswith("_test") else 1) for name, n in windows_of.items()}
    filled = {part: {c for c in shaped.columns if shaped.where((F.col("part") == part) & F.col(c).isNotNull()).count()} - {"part", *wf.WINDOW} for part in ("recurrent", "dense", "y")}
    assert filled["recurrent"] == {"step", "lat", "lon", "sog", "cog", "hour", "day_of_week"}
    assert filled["dense"] == {"year", "month", "distance_traveled"}
    assert filled["y"] == {"step", "lat", "lon", "sog", "cog"}
    km = shaped.where("part = 'x' and dataset = 'valid_long_term_test' and window_id = 1").select("step", "sog", "distance_traveled").orderBy("step").collect()
    assert [(r["step"], round(r["sog"], 6)) for r in km] == [(1, 0.75), (2, 1.0)]
    assert km[0]["distance_traveled"] == km[1]["distance_traveled"]
    assert exchanges(shaped) == 1


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def resampled_rows(spark, sizes):
    rng = random.Random(3)
    rows = [(t, "train", i, n, 300 * i, 27 + rng.random(), -84 + rng.random(), rng.choice([None, rng.random()]), rng.random()) for t, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "track long, split string, row_index long, row_count long, base_datetime long, lat double, lon double, sog double, cog double")


def test_window_features_are_those_of_copied_rows_after_one_shuffle(spark):
    cfg = replace(CFG, history=6, future=3, step=300, window_movement=900)
    df = resampled_rows(spark, [5, 10, 11, 83, 400])
    cuts = (windows.Cut("some", 7),)
    got = windows.windows_of(windows.window_blocks(df, cfg, ["lat", "lon", "sog"]), cfg, cuts)
    got = wf.last_steps(wf.with_window_distance(wf.with_window_bearings(wf.with_window_stats(got, ["sog"]))))
    assert exchanges(got) == 1
    copied = {}
    for r in windows.sliding_windows(df, cfg.window_length, 7).collect():
        copied.setdefault((r["track"], r["window_id"]), []).append(r)
    rows = got.collect()
    assert len(rows) == len(copied) > 60
    for r in rows:
        steps = sorted(copied[r["track"], r["window_id"]], key=lambda s: s["step"])
        there = sorted(s["sog"] for s in steps if s["sog"] is not None)
        assert (r["sog_min"], r["sog_max"], r["lat"], r["lats"]) == (there[0], there[-1], steps[-1]["lat"], [s["lat"] for s in steps])
        assert r["sog_median"] == pytest.approx(float(np.median(there)))
        ends = [steps[i][c] for i in (0, -1) for c in ("lat", "lon")]
        assert r["distance_traveled"] == pytest.approx(float(great_circle_km(*ends)))
        angles = [bearing_of(a["lat"], a["lon"], b["lat"], b["lon"]) for a, b in zip(steps, steps[1:])]
        assert r["mean_bearing_angle"] == pytest.approx(np.mean(angles)) and r["std_bearing_angle"] == pytest.approx(np.std(angles))


def bearing_of(lat1, lon1, lat2, lon2):
    a, b, d = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
    angle = math.degrees(math.atan2(math.cos(b) * math.sin(d), math.cos(a) * math.sin(b) - math.sin(a) * math.cos(b) * math.cos(d)))
    return angle + 360 if angle < 0 else angle


def test_nearest_cells_through_tiles_are_the_nearest_of_all(spark):
    rng = random.Random(4)
    cells = sorted((26 + (i * 7 % 30) / 10, -85 + (i % 17) / 4) for i in range(90))
    grid = [(lat, lon, rng.randrange(-99, 99), rng.choice([None, rng.randrange(-99, 99)])) for lat, lon in dict.fromkeys(cells)]
    ships = [(i, 25 + 5 * rng.random(), -86 + 6 * rng.random()) for i in range(300)] + [(1000, 26.0, -85.0), (1001, 26.025, -84.875), (1002, None, -85.0)]
    df = spark.createDataFrame([(*s, grid) for s in ships], "id long, lat double, lon double, currents array<struct<lat: double, lon: double, u: int, v: int>>")
    index = nearest.near_index(df, nearest.grid_of(df.limit(1)), 50)
    sizes = [r[0] for r in index.select(F.size("candidates")).collect()]
    assert max(sizes) < len(grid)
    got = {r["id"]: r for r in nearest.nearest_arrays(nearest.nearest_stats(df, index), index).collect()}
    for i, lat, lon in ships[:-1]:
        order = sorted(grid, key=lambda c: (math.floor(great_circle_km(lat, lon, c[0], c[1]) * 1e6 + 0.5), c[0], c[1]))
        assert got[i]["closest_weather_lats"] == [c[0] for c in order[:35]] and got[i]["closest_weather_us"] == [c[2] for c in order[:35]]
        for n in (50, 25, 10, 5, 1):
            speeds = [math.hypot(c[2], c[3]) for c in order[:n] if c[3] is not None]
            mean = got[i][f"{n}_closest_weather_magnitude_mean"]
            assert mean == pytest.approx(np.mean(speeds)) if speeds else mean is None
            if n > 1:
                std = got[i][f"{n}_closest_weather_magnitude_std"]
                assert std == pytest.approx(np.std(speeds, ddof=1)) if len(speeds) > 1 else std is None
    assert got[1002]["50_closest_weather_magnitude_mean"] is None and got[1002]["closest_weather_lats"] is None


@pytest.mark.parametrize("ranges", [None, {"lat": (20.0, 40.0), "lon": (-90.0, -80.0), "hour": (0.0, 23.0), "day_of_week": (0.0, 6.0), "distance_traveled": (0.0, 500.0)}])
def test_fed_back_predictions_are_the_states_advanced_one_by_one(spark, ranges):
    names = ["lat", "lon", "sog", "hour", "day_of_week", "distance_traveled"]
    rng = random.Random(6)
    states = [[(27 + rng.random(), -84 + rng.random(), rng.random(), float(h), float(d), 1.0) for h, d in hours] for hours in ([(22, 6), (22, 6), (23, 6)], [(5, 1), (5, 1), (5, 1)], [(23, 6), (23, 6), (23, 6)])]
    df = spark.createDataFrame([(i, 0, s) for i, s in enumerate(states)], f"track long, window_id long, state array<struct<{', '.join(f'{n}: double' for n in names)}>>")
    feedback = scoring.Feedback(tuple(names), ("lat", "lon", "sog"), 30, ranges)

    def model(x):
        last = {n: feedback.read(x[:, -1, i], n) for i, n in enumerate(names)}
        out = {"lat": last["lat"] + last["hour"] / 100 + last["day_of_week"] / 1000, "lon": last["lon"] + last["distance_traveled"] / 10_000, "sog": last["sog"] + 1}
        return np.column_stack([feedback.store(out[n], n) for n in ("lat", "lon", "sog")])

    def scaled(c):
        low, high = (ranges or {}).get(c, (0.0, 1.0))
        return lambda s: (s[c] - low) / (high - low)

    sequences = df.withColumn("sequence", F.transform("state", lambda s: F.array(*[scaled(n)(s) for n in names])))
    got = scoring.predicted_steps(scoring.with_predictions(sequences, scoring.fed_back(model, 5, feedback), feedback.outputs))
    back = {f"pred_{n}": F.col(f"pred_{n}") * (hi - lo) + lo for n, (lo, hi) in (ranges or {}).items() if n in ("lat", "lon")}
    rows = {(r["track"], r["step_index"]): r for r in got.withColumns(back).collect()}
    current = df
    for index in range(5):
        last = F.element_at("state", -1)
        moved = {"lat": last["lat"] + last["hour"] / 100 + last["day_of_week"] / 1000, "lon": last["lon"] + last["distance_traveled"] / 10_000, "sog": last["sog"] + 1}
        current = scoring.advance_state(current, moved, 30)
        for r in current.select("track", F.element_at("state", -1).alias("s")).collect():
            assert [rows[r["track"], index][f"pred_{n}"] for n in ("lat", "lon", "sog")] == pytest.approx([r["s"][n] for n in ("lat", "lon", "sog")])


def test_errors_by_step_need_no_join(spark):
    point = "array<struct<lat: double, lon: double>>"
    df = spark.createDataFrame([(1, 0, [(0.0, 0.0), (0.0, 1.0)], [(0.0, 0.0), (0.0, 2.0), (1.0, 1.0)])], f"track long, window_id long, predicted {point}, true {point}")
    out = scoring.step_errors(df)
    assert exchanges(out) == 0 and "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r["step_index"], None if r["error_km"] is None else round(r["error_km"])) for r in out.collect()] == [(0, 0), (1, 111), (2, None)]
