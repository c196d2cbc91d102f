"""Hand-worked cases of the cleaning and track rules."""

import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from keelson.config import Config
from keelson.functions import ordered
from keelson.functions.names import to_snake_case
from keelson.operators import cleaning, resample, tracks
from keelson.sources import catalogue, messages

CFG = Config()
NM_IN_DEGREES = 1 / (6371.0088 * 0.539956803 * math.pi / 180)


def ship(spark, rows, mmsi="201000001"):
    """Rows of (seconds, lat, lon)."""
    data = [(i, mmsi, t, float(lat), float(lon)) for i, (t, lat, lon) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id bigint, mmsi string, base_datetime bigint, lat double, lon double")


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def test_stationary_rows_go_unless_they_start_a_track(spark):
    rows = [(0, 1, 1), (60, 1, 1), (120, 1, 1), (180, 2, 1), (180 + 7201, 2, 1)]
    assert ids(cleaning.drop_stationary(ship(spark, rows), CFG)) == [0, 3, 4]


def test_first_row_far_from_the_rest_is_an_outlier(spark):
    north = [0.0, 100.0, 105.0, 110.0]
    rows = [(3600 * i, n * NM_IN_DEGREES, 0) for i, n in enumerate(north)]
    assert ids(cleaning.speed_outlier_pass(ship(spark, rows), CFG)) == [1, 2, 3]
    assert ids(cleaning.speed_outlier_pass(ship(spark, [(0, 1, 1)]), CFG)) == []
    assert ids(cleaning.speed_outlier_pass(ship(spark, [(0, 1, 1)]), CFG, complete=False)) == [0]


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_speed_rule_repeats_until_nothing_drops(spark, hot_rows):
    # 0, 20, 70, 70.001, 170, 190 miles north, hour by hour: D falls first, then C.
    north = [0, 20, 70, 70.001, 170, 190]
    rows = [(3600 * i, n * NM_IN_DEGREES, 0) for i, n in enumerate(north)]
    cfg = replace(CFG, hot_rows=hot_rows)
    assert ids(cleaning.speed_outlier_pass(ship(spark, rows), cfg)) == [0, 1, 2, 4, 5]
    assert ids(cleaning.speed_outliers(ship(spark, rows), cfg)) == [0, 1, 4, 5]


def test_speed_at_one_instant(spark):
    out = cleaning.with_empirical_speed(ship(spark, [(0, 1, 1), (0, 2, 1), (0, 2, 1)]), CFG).orderBy("event_id").collect()
    assert out[1]["prev_knots"] == math.inf
    assert out[2]["prev_knots"] is None


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_tracks_break_only_beyond_the_gap(spark, hot_rows):
    rows = ship(spark, [(0, 1, 1), (7200, 1, 1), (14401, 1, 1)])
    out = tracks.assign_tracks(rows, replace(CFG, hot_rows=hot_rows)).orderBy("event_id").collect()
    assert [r["track"] for r in out] == [201000001000001, 201000001000001, 201000001000002]


def test_tracks_do_not_depend_on_chunks_or_partitions(spark):
    random.seed(5)
    data = [
        (i, f"20100000{random.randrange(3)}", random.randrange(0, 400_000), random.random(), random.random())
        for i in range(600)
    ]
    rows = spark.createDataFrame(data, "event_id bigint, mmsi string, base_datetime bigint, lat double, lon double")
    want = None
    for hot_rows, parts in ((1_000_000, 1), (1, 5), (40, 3)):
        out = tracks.assign_tracks(rows.repartition(parts), replace(CFG, hot_rows=hot_rows))
        got = sorted((r["event_id"], r["track"]) for r in out.select("event_id", "track").collect())
        want = want or got
        assert got == want
    expected, last, number = {}, {}, {}
    for eid, mmsi, t, _, _ in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        if mmsi not in last or t - last[mmsi] > CFG.track_gap:
            number[mmsi] = number.get(mmsi, 0) + 1
        last[mmsi] = t
        expected[eid] = int(mmsi) * 1_000_000 + number[mmsi]
    assert want == sorted(expected.items())


def test_minimum_length_is_strict(spark):
    for last, kept in ((21_600, 0), (21_601, 73)):
        rows = tracks.assign_tracks(ship(spark, [(t, t / 1e4, 0) for t in (0, 6000, 12000, 18000, last)]), CFG)
        long = tracks.filter_short_tracks(rows, CFG)
        assert resample.resample_grid(long, CFG).count() == kept


def test_tracks_near_the_period_end_stay(spark):
    for end, kept in ((86_399 - 7200, 2), (86_399 - 7201, 0)):
        rows = ship(spark, [(end - 100, 1, 1), (end, 2, 1)]).withColumns(
            {"period": F.lit(0), "track": F.lit(1), "min_time": F.lit(0), "max_time": F.lit(86_399)}
        )
        assert tracks.filter_short_tracks_in_period(rows, CFG).count() == kept


def test_test_months():
    assert tracks.test_months(60, 0.2) == 12
    assert tracks.test_months(10, 0.25) == 2
    assert tracks.test_months(3, 0.2) == 0


def test_split_of_tracks_is_whole_and_sized(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("track"), "id")
    out = tracks.track_split(rows, 0.2, "1").groupBy("split").agg(F.count_distinct("track"), F.count("id"))
    assert sorted(map(tuple, out.collect())) == [("train", 80, 800), ("valid", 20, 200)]


def test_speed_rule_runs_until_nothing_drops(spark):
    """Each pass drops one row only: the next jump is seen when its neighbour is gone."""
    n = 70
    rows = [("1", i, 60 * i, 0.0 if i == 0 else 1.0 + 0.02 * (n - i), 0.0) for i in range(n)]
    df = spark.createDataFrame(rows, "mmsi string, event_id long, base_datetime long, lat double, lon double")
    left = cleaning.speed_outliers(df, CFG).count()
    again = cleaning.speed_outliers(cleaning.speed_outliers(df, CFG).drop("_chunk"), CFG).count()
    assert left == again < n


def test_snake_case():
    cases = {"BaseDatetime": "base_datetime", "TransceiverClass": "transceiver_class", "MMSI": "mmsi", "VesselType": "vessel_type"}
    cases |= {"CargoWeight": "cargo_weight", "IMONumber": "imo_number", "shipName2": "ship_name2", "Port Of-Call": "port_of_call", "snake_case": "snake_case", "X": "x", "_": "_"}
    assert {k: to_snake_case(k) for k in cases} == cases


def test_unknown_file_names_and_years_raise(spark):
    with pytest.raises(Exception, match="unknown file name"):
        catalogue.parse_specifier(spark.createDataFrame([("x.csv",)], "path string"), "path").collect()
    years = spark.createDataFrame([(2014,)], "year int")
    with pytest.raises(Exception, match="no file layout"):
        catalogue.expected_partitions(years, spark.createDataFrame([(10,)], "zone int"), "zip").collect()


def test_messages_are_read_by_header(spark, tmp_path):
    def file(name, *lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return str(tmp_path / name)

    good = file("a.csv", "LAT,MMSI,TranscieverClass,BaseDateTime", "1.5,201,A,2017-01-01T00:00:00")
    row = messages.read_messages(spark, good).first()
    assert (row["MMSI"], row["LAT"], row["TransceiverClass"], row["Cargo"], row["LON"]) == ("201", 1.5, "A", None, None)
    bad = file("b.csv", "LAT,MMSI", "x,202", "2.5,203")
    with pytest.raises(Exception, match="MALFORMED|BAD_RECORD|FAILFAST|FAILED_READ"):
        messages.read_messages(spark, bad).collect()
    kept = messages.read_messages(spark, bad, bad_record="bad").orderBy("MMSI").collect()
    assert [(r["MMSI"], r["LAT"], r["bad"]) for r in kept] == [("202", None, "x,202"), ("203", 2.5, None)]
    with pytest.raises(ValueError, match="unknown columns"):
        messages.read_messages(spark, file("c.csv", "LAT,Depth", "1,2"))


def test_files_of_other_column_order_raise_with_bad_records_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("MMSI,LAT,LON\n1,2.0,3.0\n")
    assert messages.read_messages(spark, str(tmp_path), bad_record="bad").select("LAT", "LON", "bad").collect() == [(2.0, 3.0, None)]
    (tmp_path / "b.csv").write_text("MMSI,LON,LAT\n2,3.0,2.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        messages.read_messages(spark, str(tmp_path), bad_record="bad").collect()


def test_rows_and_chunk_summaries_share_one_scan_and_one_exchange(spark, tmp_path):
    spark.range(3000).selectExpr(
        "id as event_id", "cast(201000000 + id % 7 as string) as mmsi", "id * 50 as base_datetime", "id / 1000D as lat", "2D as lon"
    ).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    steps = {
        "track": lambda: tracks.assign_tracks(df, CFG), "stationary": lambda: cleaning.flag_stationary(df, CFG),
        "speed": lambda: cleaning.flag_speed_outliers(df, CFG), "position": lambda: ordered.with_position(ordered.with_chunk(df), ["mmsi"], ["base_datetime", "event_id"]),
    }
    for name, step in steps.items():
        out = step()
        out.collect()
        text = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # the rows' exchange is read again by the summaries; the others are a row per chunk
        assert (name, text.count("FileScan"), text.count("ReusedExchange")) == (name, 1, 1)


def test_rows_without_ship_or_time_are_left_out(spark):
    rows = [("1", 1, 0, 1.0, 1.0), (None, 2, 5, 1.0, 1.0), ("1", 3, None, 1.0, 1.0), ("1", 4, 60, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "mmsi string, event_id long, base_datetime long, lat double, lon double")
    assert sorted(r["event_id"] for r in tracks.assign_tracks(df, CFG).collect()) == [1, 4]
    assert sorted(r["event_id"] for r in cleaning.flag_stationary(df, CFG).collect()) == [1, 4]
