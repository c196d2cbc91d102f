"""Full tensors against a plain expansion of every window."""

from collections import Counter
from dataclasses import replace

from keelson.config import Config
from keelson.plans import tensors

CFG = replace(Config(), history=3, future=2, step=3600, window_movement=3600, time_gaps=(3600, 7200))
START = 1_704_067_200  # 2024-01-01 00:00 UTC
FEATURES, CATEGORIES = ["lat", "sog"], ["vessel_group", "destination_cluster"]
ROWS = "track long, split string, row_index long, row_count long, base_datetime long, lat double, sog double, vessel_group string, destination_cluster long"
CELL = "year int, month int, day int, hour int, currents array<struct<lat: double, lon: double, u: smallint, v: smallint>>"


def given(spark):
    tracks = [("train", "cargo", 3), ("train", "tug tow", -1), ("valid", "tanker", 3), ("valid", None, 7), ("test", "cargo", None)]
    rows = [
        (t, split, i, 10, START + 3600 * (i + t), 27 + t + i / 8, None if i == 4 else float(i), group, cluster)
        for t, (split, group, cluster) in enumerate(tracks) for i in range(10)
    ]
    # Stamps of hours 0, 3 and 9: that of hour 6 is missing, and two cells are not known at every stamp.
    stamps = [(2024, 1, 1, 0, [(26.0, -84.0, 5, 6), (27.0, -84.0, -3, 1)]), (2024, 1, 1, 3, [(26.0, -84.0, 8, None)]), (2024, 1, 1, 9, [(26.0, -84.0, -20, 2), (27.0, -84.0, 9, 9)])]
    return rows, stamps


def plain(rows, stamps, dataset, gap, x_or_y):
    """Sequences by (track, window) as a loop over rows gives them."""
    train = [r for r in rows if r[1] == "train"]
    levels = [sorted({str(r[c]) for r in train if r[c] is not None}) for c in (7, 8)]
    at = {START + 3600 * h: {c[:2]: c[2:] for c in cells} for _, _, _, h, cells in stamps}
    counts = Counter(r[4] - r[4] % 10800 for r in train)
    cells = sorted({c for known in at.values() for c in known})

    def mean(cell, side):
        seen = [(known[cell][side], counts[stamp]) for stamp, known in at.items() if cell in known and known[cell][side] is not None]
        return round(sum(v * n for v, n in seen) / sum(n for _, n in seen))

    means = {cell: (mean(cell, 0), mean(cell, 1)) for cell in cells}
    stride = 1 if dataset.endswith("train") else CFG.history
    steps = list(range(0, 3, gap // 3600)) if x_or_y == "x" else list(range(3 + gap // 3600 - 1, 6, gap // 3600))
    out = {}
    for track in {r[0] for r in rows if f"{r[1]}_long_term" == dataset.rsplit("_", 1)[0]}:
        own = [r for r in rows if r[0] == track]
        for window in range((len(own) - 6) // stride + 1):
            sequence = []
            for s in steps:
                r = own[window * stride + s]
                hot = [float(str(r[c]) == level) for c, known in zip((7, 8), levels) for level in known]
                here = at.get(r[4] - r[4] % 10800, {})
                sides = [[float(here[cell][i]) if cell in here and here[cell][i] is not None else float(means[cell][i]) for cell in cells] for i in (0, 1)]
                sequence.append([r[5], r[6], *hot, *sides[0], *sides[1]])
            out[track, window] = sequence
    return out


def test_full_tensors_are_the_plain_expansion(spark, tmp_path):
    rows, stamps = given(spark)
    df, packed = spark.createDataFrame(rows, ROWS), spark.createDataFrame(stamps, CELL)
    path = str(tmp_path / "tensors")
    shapes = {tuple(r[:3]): tuple(r[3:]) for r in tensors.write_full(df, path, CFG, FEATURES, CATEGORIES, packed).collect()}
    assert len(shapes) == 4 * 2 * 2
    for (dataset, gap, side), (n, steps, features) in shapes.items():
        want = plain(rows, stamps, dataset, gap, side)
        got = {(r["track"], r["window_id"]): r["sequence"] for r in tensors.read_full(spark, path, dataset, gap, side, CATEGORIES).collect()}
        assert got == want and n == len(want)
        assert {len(s) for s in want.values()} == {steps} and {len(f) for s in want.values() for f in s} == {features}
    names = [tuple(r) for r in tensors.layout(spark, path, FEATURES, CATEGORIES).orderBy("position").collect()]
    assert [n[1:] for n in names[:6]] == [("lat", None), ("sog", None), ("vessel_group", "cargo"), ("vessel_group", "tug tow"), ("destination_cluster", "-1"), ("destination_cluster", "3")]
    assert [n[1] for n in names[6:]] == ["water_u"] * 2 + ["water_v"] * 2 and [n[0] for n in names] == list(range(10))


def test_no_rows_give_no_tensors(spark, tmp_path):
    rows, stamps = given(spark)
    path = str(tmp_path / "tensors")
    empty = spark.createDataFrame(rows, ROWS).limit(0)
    shapes = tensors.write_full(empty, path, CFG, FEATURES, CATEGORIES, spark.createDataFrame(stamps, CELL))
    assert shapes.count() == 0
