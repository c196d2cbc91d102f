"""Clustering against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import clustering, destinations


def distances(points):
    lat, lon = np.radians(points[:, 0]), np.radians(points[:, 1])
    h = (
        np.sin((lat[:, None] - lat[None]) / 2) ** 2
        + np.cos(lat[:, None]) * np.cos(lat[None]) * np.sin((lon[:, None] - lon[None]) / 2) ** 2
    )
    return 2 * 6371 * np.arcsin(np.sqrt(np.clip(h, 0, 1)))


def brute(points, eps, min_pts):
    near = distances(points) <= eps
    core = near.sum(1) >= min_pts
    labels, cluster = np.full(len(points), -1), 0
    for i in range(len(points)):
        if labels[i] != -1 or not core[i]:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if labels[j] == -1:
                labels[j] = cluster
                if core[j]:
                    todo.extend(np.flatnonzero(near[j] & (labels == -1)))
        cluster += 1
    return labels, core


def frame(spark, points):
    data = [(i, str(i % 7), float(a), float(b)) for i, (a, b) in enumerate(points)]
    return spark.createDataFrame(data, "track long, mmsi string, lat double, lon double")


def clouds(rng, centers, n, spread):
    return np.concatenate([rng.normal(c, spread, (n, 2)) for c in centers])


@pytest.mark.parametrize("direct_pairs", [4096, 0])
@pytest.mark.parametrize(
    "centers,spread",
    [
        ([(27.0, -84.0), (27.3, -84.0), (27.35, -83.6)], 0.06),
        ([(10.0, 179.97), (10.05, -179.95)], 0.05),
        ([(70.0, 20.0), (70.1, 20.6)], 0.05),
    ],
)
def test_dbscan_equals_brute_force(spark, direct_pairs, centers, spread):
    rng = np.random.default_rng(3)
    points = clouds(rng, centers, 70, spread)
    points[:, 1] = (points[:, 1] + 180) % 360 - 180
    points = np.concatenate([points, points[:30], rng.uniform((9, -85), (28, -80), (15, 2))])
    want, core = brute(points, 4.0, 5)
    out = clustering.dbscan(frame(spark, points), 4.0, 5, direct_pairs=direct_pairs).orderBy("track").collect()
    assert [r["cluster"] for r in out] == want.tolist()
    assert [r["is_core"] for r in out] == core.tolist()


def test_a_pile_of_copies_is_one_spot(spark):
    points = np.array([(27.0, -84.0)] * 50 + [(27.001, -84.0)])
    out = clustering.dbscan(frame(spark, points), 1.0, 51).collect()
    assert {(r["cluster"], r["is_core"]) for r in out} == {(0, True)}


def test_knn_curve_counts_the_point_itself(spark):
    rng = np.random.default_rng(4)
    points = clouds(rng, [(27.0, -84.0)], 60, 0.2)
    points = np.concatenate([points, points[:5]])
    curve = clustering.knn_distance_curve(frame(spark, points), (2, 6), 2.0).collect()
    ordered = np.sort(distances(points), axis=1)
    for m in (2, 6):
        want = np.sort(ordered[:, m - 2])[::-1]
        got = [r["km"] for r in sorted(curve, key=lambda r: r["first_rank"]) if r["min_pts"] == m for _ in range(r["last_rank"] - r["first_rank"] + 1)]
        assert got == pytest.approx(want.tolist(), abs=1e-6)


def test_knn_curve_compares_no_crowd_with_itself(spark, monkeypatch):
    rng = np.random.default_rng(8)
    crowd = rng.uniform((27.0, -84.0), (27.02, -83.98), (2500, 2))
    points = np.concatenate([crowd, crowd[:40], rng.uniform((20.0, -90.0), (30.0, -80.0), (30, 2)), [(-89.0, 179.99), (-89.0, -179.99)]])
    met, plain = [], clustering.radius_candidates

    def counted(*args, **kwargs):
        out = plain(*args, **kwargs)
        met.append(out.count())
        return out

    monkeypatch.setattr(clustering, "radius_candidates", counted)
    curve = clustering.knn_distance_curve(frame(spark, points), (2, 6), 20.0).collect()
    assert sum(met) < 600 * len(points)
    ordered = np.sort(distances(points), axis=1)
    for m in (2, 6):
        want = np.sort(ordered[:, m - 2])[::-1]
        got = [r["km"] for r in sorted(curve, key=lambda r: r["first_rank"]) if r["min_pts"] == m for _ in range(r["last_rank"] - r["first_rank"] + 1)]
        assert got == pytest.approx(want.tolist(), abs=1e-6)


def test_knn_curve_of_piles_and_positions_without_a_coordinate(spark):
    rows = [(i, 5.0, 5.0) for i in range(6)] + [(i, 5.0, 5.0 + i * 1e-9) for i in range(6, 9)] + [(9, None, 5.0), (10, None, None)]
    points = spark.createDataFrame(rows, "track long, lat double, lon double")
    curve = clustering.knn_distance_curve(points, (1, 6), 10.0, max_radius=4.0).collect()
    for m in (1, 6):
        spans = sorted((r["first_rank"], r["last_rank"], r["km"]) for r in curve if r["min_pts"] == m)
        assert spans[0] == (1, 2, None) and spans[-1][1:] == (11, 0.0) and all(km < 1e-6 for _, _, km in spans[1:])


def test_radius_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    points = clouds(rng, [(70.0, 179.9), (70.1, -179.9), (27.0, -84.0)], 60, 0.2)
    points[:, 1] = (points[:, 1] + 180) % 360 - 180
    points = np.concatenate([points, points[:9]])
    near = distances(points) <= 9.0
    out = clustering.radius_neighbours(frame(spark, points), 9.0)
    assert {(r["a"], r["b"]) for r in out.collect()} == {(a, b) for a, b in zip(*np.nonzero(near)) if a < b}


def test_radius_neighbours_in_parts_of_the_radius_equal_brute_force(spark):
    rng = np.random.default_rng(10)
    points = clouds(rng, [(70.0, 179.9), (70.2, -179.8), (27.0, -84.0)], 60, 0.3)
    points[:, 1] = (points[:, 1] + 180) % 360 - 180
    points = np.concatenate([points, points[:9], points[:9]])
    keys = [None if i % 50 == 7 else i - 1 if i % 40 == 3 else i for i in range(len(points))]
    data = [(k, float(a), float(b)) for k, (a, b) in zip(keys, points)] + [(900, None, 5.0), (901, 70.0, None), (902, None, None)]
    km = distances(points)
    for eps in (3.0, 30.0):
        want = sorted((keys[i], keys[j], km[i, j]) for i, j in zip(*np.nonzero(km <= eps)) if None not in (keys[i], keys[j]) and keys[i] < keys[j])
        got = sorted(tuple(r) for r in clustering.radius_neighbours(spark.createDataFrame(data, "track long, lat double, lon double"), eps).collect())
        assert [r[:2] for r in got] == [r[:2] for r in want]
        assert [r[2] for r in got] == pytest.approx([r[2] for r in want], abs=1e-6)


def test_radius_neighbours_leave_in_an_order_that_packs(spark, tmp_path):
    rng = np.random.default_rng(11)
    points = rng.uniform((27.0, -84.0), (27.14, -83.86), (2500, 2))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        out = clustering.radius_neighbours(frame(spark, points[rng.permutation(2500)]), 20.0)
        out.withColumn("km", F.round("km", 4)).write.parquet(str(tmp_path / "pairs"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    n = spark.read.parquet(str(tmp_path / "pairs")).count()
    near = distances(points) <= 20.0
    assert n == (near.sum() - 2500) // 2
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 5 * n


def test_nearest_core_wins(spark):
    rng = np.random.default_rng(6)
    points = clouds(rng, [(27.0, -84.0), (27.1, -84.0)], 60, 0.02)
    labelled = clustering.dbscan(frame(spark, points), 2.0, 5).cache()
    rows = labelled.orderBy("track").collect()
    spots = np.concatenate([rng.uniform((26.9, -84.1), (27.2, -83.9), (80, 2))])
    out = clustering.assign_destination_nearest(frame(spark, spots), labelled, 2.0).orderBy("track").collect()
    cores = np.array([(r["lat"], r["lon"]) for r in rows if r["is_core"]])
    names = [r["cluster"] for r in rows if r["is_core"]]
    for spot, row in zip(spots, out):
        km = distances(np.concatenate([[spot], cores]))[0, 1:]
        assert row["cluster"] == (names[km.argmin()] if km.min() <= 2.0 else -1)


def test_destination_model_takes_many_clusters_and_loses_no_row(spark):
    points = spark.range(900).select(
        F.col("id").alias("track"), F.col("id").alias("event_id"), F.lit("1").alias("mmsi"), F.lit(0).alias("base_datetime"),
        (F.col("id") % 300 % 17 / 3.1).alias("lat"), (F.floor(F.col("id") % 300 / 17) / 2.9).alias("lon"), (F.col("id") % 300).alias("cluster"),
    )
    model, report = destinations.fit_destination_model(points, holdout=100, trees=20)
    row = report.first()
    assert row["tested"] == 100 and row["correct"] >= 95 and row["oob_rows"] >= 750 and row["oob_accuracy"] >= 0.9
    centers = clustering.cluster_centers(points.where("cluster <> 3"))
    lost = spark.createDataFrame([(5000, 1, "1", 0, None, 1.0), (5001, 1, "1", 0, 80.0, 80.0)], points.drop("cluster").schema)
    out = clustering.assign_destination(points.drop("cluster").unionByName(lost), model, centers)
    assert out.count() == 902 and out.where("destination_cluster = '3' and destination_cluster_lat_center is not null").isEmpty()
    assert {r["destination_cluster"] for r in out.where("track >= 5000").collect()} == {"-1"}
    with pytest.raises(ValueError, match="held out"):
        destinations.fit_destination_model(points, holdout=900)


def test_sixty_thousand_clusters_fit(spark):
    at = F.floor(F.col("id") / 3)
    points = spark.range(180_000).select(
        F.col("id").alias("track"), ((at / 600).cast("int") * 0.9 - 80 + (F.col("id") % 3) / 100).alias("lat"), (at % 600 * 0.6 - 179).alias("lon"), at.alias("cluster")
    )
    model, report = destinations.fit_destination_model(points, holdout=3000, trees=5)
    row = report.first()
    assert row["tested"] == 3000 and row["accuracy"] > 0.97 and model.forests.select(F.explode("label").alias("c")).distinct().count() > 58_000


def test_cuts_are_the_best_of_all():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = int(rng.integers(2, 30))
        x, y, w = rng.integers(0, 8, n).astype(float), rng.integers(0, 4, n), rng.integers(1, 4, n).astype(float)

        def impurity(side):
            weights = np.bincount(y[side], w[side])
            return weights.sum() - (weights**2).sum() / weights.sum()

        want = min((impurity(x <= c) + impurity(x > c) for c in np.unique(x)[:-1]), default=np.inf)
        score, threshold = destinations.best_split(x, y, w)
        if np.isfinite(want):
            assert w.sum() + score == pytest.approx(want)
            assert impurity(x <= threshold) + impurity(x > threshold) == pytest.approx(want)
        else:
            assert score == np.inf


def test_forest_tells_apart_what_cuts_can_tell_apart():
    rng = np.random.default_rng(7)
    points = rng.random((400, 2))
    labels = (points[:, 0] > 0.5).astype(np.int64) * 10 + (points[:, 1] > 0.3).astype(np.int64)
    forest = destinations.fit_forest(points, labels, 30, 25, 0.8, rng)
    fresh = rng.random((500, 2))
    truth = (fresh[:, 0] > 0.5) * 10 + (fresh[:, 1] > 0.3)
    assert (destinations.majority(destinations.votes(forest, fresh))[0] == truth).mean() > 0.96
    assert forest["oob_rows"] == 400 and forest["oob_correct"] > 380
    stump = destinations.grow(points, labels % 10, np.ones(400), 0)
    assert stump["feature"] == [-1]


def test_positions_without_a_coordinate_stay_as_noise(spark):
    rows = [(i, "1", 1.0 + i / 1000, 1.0) for i in range(4)] + [(9, "1", None, 1.0), (10, "1", None, None)]
    df = spark.createDataFrame(rows, "track long, mmsi string, lat double, lon double")
    got = {r["track"]: (r["is_core"], r["cluster"]) for r in clustering.dbscan(df, 5.0, 3).collect()}
    assert got == {0: (True, 0), 1: (True, 0), 2: (True, 0), 3: (True, 0), 9: (False, -1), 10: (False, -1)}


def test_points_without_enough_neighbours_stay_in_the_curve(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.01), (3, 60.0, 0.0)], "track long, lat double, lon double")
    curve = clustering.knn_distance_curve(points, (2, 3), 1.0, max_radius=50.0).collect()
    assert sorted((r["min_pts"], r["first_rank"], r["last_rank"], r["km"] is None) for r in curve) == [(2, 1, 3, False), (3, 1, 1, True), (3, 2, 3, False)]
