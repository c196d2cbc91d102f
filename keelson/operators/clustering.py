"""Density clustering of final positions.

Distances are great-circle kilometres.  Identical positions are merged into one weighted
spot first, so piles of copies cost nothing.  In a cell no wider than the radius all
spots are mutual neighbours: a cell heavy enough consists of core spots only, and no pairs
inside it are ever formed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.config import CLUSTER_SAMPLE_SEED
from keelson.functions.cells import CELL, radius_candidates, with_cell, with_ring
from keelson.functions.geo import CLUSTER_RADIUS_KM, haversine
from keelson.functions.ordered import rank_in_buckets, shuffled_rank
from keelson.functions.storage import cut

RUN = ("run", "eps_km", "min_pts")
DIRECT_PAIRS = 4096
HALF_GLOBE_KM = 20_100.0
# Below a centimetre, positions in degrees are not told apart any further.
FINEST_KM = 1e-5
# Distances of this width, to four decimals, have so few values that Parquet numbers them: 20,000 of them, a page, repeat
# often enough.  Beyond so many parts a radius is not divided any further.
PART_KM = 3.4
MOST_PARTS = 6
FINE_CELLS = 7


def final_messages(df: DataFrame) -> DataFrame:
    """Last message of each track: (track, mmsi, lat, lon, lat_rad, lon_rad)."""
    last = F.max_by(F.struct("mmsi", "lat", "lon"), F.struct("base_datetime", *[c for c in ("event_id",) if c in df.columns]))
    rows = df.groupBy("track").agg(last.alias("_last")).select("track", "_last.*")
    return rows.withColumns({"lat_rad": F.radians("lat"), "lon_rad": F.radians("lon")})


def cap_sample(df: DataFrame, n: int, seed: str = CLUSTER_SAMPLE_SEED, key: str = "track") -> DataFrame:
    """Exactly n rows by a seeded digest of the key, or all rows if there are fewer."""
    return shuffled_rank(df, seed, F.col(key)).where(F.col("rank") <= n).drop("rank", "total")


def _km() -> Column:
    return haversine(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon"), radius=CLUSTER_RADIUS_KM)


def radius_neighbours(df: DataFrame, eps_km: float, key: str = "track") -> DataFrame:
    """(a, b, km) for every two points within ``eps_km``, a < b.

    The pairs are the result and are far more than the points, so they leave in an order that keeps columnar files small.
    Each part of the radius is a join of its own: a task writes distances of at most ``PART_KM`` width, few enough to be
    numbered once they are rounded.  Points go in by small cells, so that one and the next have much the same neighbours.
    """
    points = df.select(key, "lat", "lon")
    near_by = with_cell(points.withColumn("eps_km", F.lit(eps_km / FINE_CELLS))).orderBy(*CELL, key)
    points = cut(near_by.select(key, "lat", "lon"))
    n = min(MOST_PARTS, max(1, math.ceil(eps_km / PART_KM)))
    ends = [*[eps_km * i / n for i in range(1, n)], eps_km]
    return reduce(DataFrame.unionByName, [_pairs_between(points, low, high, key) for low, high in zip([None, *ends], ends)])


def _pairs_between(points: DataFrame, low: float | None, high: float, key: str) -> DataFrame:
    """(a, b, km) of the points more than ``low`` and at most ``high`` km apart, a < b."""
    rows = with_cell(points.withColumn("eps_km", F.lit(float(high))))
    met = radius_candidates(rows, rows, spread=True, dealt=_with_vector)
    widest = _chord(F.lit(float(high)))
    maybe = (F.col(f"l_{key}") < F.col(f"r_{key}")) & (widest.isNull() | (_squared_chord() <= widest))
    if low is not None:
        maybe &= _squared_chord() >= (2 * math.sin(low / (2 * CLUSTER_RADIUS_KM)) * (1 - 1e-6)) ** 2 - 1e-14
    # Exploded, as Spark would else put the distance into the join and compute it several times for each pair tried there.
    near = met.where(maybe).select(
        F.col(f"l_{key}").alias("a"), F.col(f"r_{key}").alias("b"), F.explode(F.array(_km())).alias("km")
    ).where(F.col("km") <= high)
    return near if low is None else near.where(F.col("km") > low)


def _spots(df: DataFrame, key: str) -> DataFrame:
    """Distinct positions with their weight and first key."""
    return df.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("w"), F.min(key).alias("first"))


def _with_vector(df: DataFrame) -> DataFrame:
    """Add the unit vector ``x``, ``y``, ``z`` of lat/lon."""
    lat, lon = F.radians("lat"), F.radians("lon")
    return df.withColumns({"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)})


def _chord(eps_km: Column) -> Column:
    """Squared chord of ``eps_km`` on the unit sphere, with room for rounding; none around the globe."""
    chord = 2 * F.sin(eps_km / (2 * CLUSTER_RADIUS_KM)) * (1 + 1e-6) + 4e-15
    return F.when(eps_km < 20_000, chord * chord)


def _maybe_near() -> Column:
    """What pairs within ``eps_km`` fulfil: a test without trigonometry before the exact distance."""
    return F.col("l_chord").isNull() | (_squared_chord() <= F.col("l_chord"))


def _squared_chord() -> Column:
    squares = [(F.col(f"l_{c}") - F.col(f"r_{c}")) * (F.col(f"l_{c}") - F.col(f"r_{c}")) for c in "xyz"]
    return squares[0] + squares[1] + squares[2]


def _starting_radii(spots: DataFrame, enough: int, start_km: float) -> tuple[DataFrame, list[float]]:
    """(lat, lon, eps_km) of each spot and the radii in use: ``start_km``, halved while the spot's own cell holds ``enough``.

    A cell of weight ``enough`` within some radius settles its spots, so no spot looks farther than its surroundings ask,
    however crowded they are.  Only spots of such cells are looked at again with half the radius.  A spot that is nowhere
    on the globe counts for no cell.
    """
    there = F.coalesce(F.col("lat").between(-90, 90) & F.col("lon").between(-360, 360), F.lit(False))
    radius, radii = float(start_km), [float(start_km)]
    done = [spots.where(~there).select("lat", "lon", F.lit(radius).alias("eps_km"))]
    crowd = spots.where(there).select("lat", "lon", "w")
    while radius / 2 >= FINEST_KM:
        half = with_cell(crowd.withColumn("eps_km", F.lit(radius / 2)))
        heavy = half.groupBy(*CELL).agg(F.sum("w").alias("_cell_w")).where(F.col("_cell_w") >= enough)
        split = cut(half.join(heavy.select(*CELL, F.lit(True).alias("_heavy")), list(CELL), "left"))
        done.append(split.where(F.col("_heavy").isNull()).select("lat", "lon", F.lit(radius).alias("eps_km")))
        crowd = split.where("_heavy").select("lat", "lon", "w")
        if crowd.isEmpty():
            break
        radius /= 2
        radii.append(radius)
    else:
        done.append(crowd.select("lat", "lon", F.lit(radius).alias("eps_km")))
    return reduce(DataFrame.unionByName, done), radii


def knn_distance_curve(
    df: DataFrame, min_pts: Sequence[int], start_km: float, max_radius: float = HALF_GLOBE_KM, key: str = "track"
) -> DataFrame:
    """Sorted neighbour distances per min_pts m: (min_pts, first_rank, last_rank, km), farthest first.

    The distance is to neighbour m - 1, the point itself counting as the first.  Points
    with equal distance share a row covering their ranks, so the curve is whole however
    many ties there are.  Each pass looks within a radius and settles the points that have
    enough neighbours inside it; the others go on with twice the radius.  The first pass takes
    for each point the smallest of ``start_km``, its half, its quarter, ... that its own cell
    shows to be enough, so the number of comparisons does not grow with the density.  Points
    that have too few neighbours within ``max_radius`` come first, with a null distance.
    """
    spots = cut(_spots(df, key))
    most = max(1, max(min_pts) - 1)
    wanted = spots.select("lat", "lon", "w", F.explode(F.array(*[F.lit(m) for m in min_pts])).alias("min_pts"))
    at, radii = _starting_radii(spots, most, start_km)
    open_spots, settled, radius = wanted, None, start_km
    while True:
        left = with_cell(_with_vector(at).withColumn("chord", _chord(F.col("eps_km"))))
        used = F.explode(F.array(*[F.lit(float(r)) for r in radii])).alias("eps_km")
        right = with_cell(_with_vector(spots).select("lat", "lon", "w", "x", "y", "z", used))
        maybe = radius_candidates(left, right, ["eps_km"], spread=True).where(_maybe_near())
        near = maybe.withColumn("km", _km()).where(F.col("km") <= F.col("eps_km"))
        # The nearest spots are enough, as each weighs one or more; Spark drops the others before the exchange.
        by_distance = Window.partitionBy("l_lat", "l_lon").orderBy("km", "r_lat", "r_lon")
        nearest = near.withColumn("_nth", F.row_number().over(by_distance)).where(F.col("_nth") <= most)
        counted = nearest.withColumn("_upto", F.sum("r_w").over(by_distance.rowsBetween(Window.unboundedPreceding, 0)))
        reached = [F.struct(F.lit(m).alias("min_pts"), F.min(F.when(F.col("_upto") >= m - 1, F.col("km"))).alias("km")) for m in sorted(set(min_pts))]
        per_spot = counted.groupBy(F.col("l_lat").alias("lat"), F.col("l_lon").alias("lon")).agg(F.array(*reached).alias("_reached"))
        found = per_spot.select("lat", "lon", F.inline("_reached")).where(F.col("km").isNotNull())
        found = cut(found.join(open_spots, ["lat", "lon", "min_pts"]).select("lat", "lon", "w", "min_pts", "km"))
        settled = found if settled is None else settled.unionByName(found)
        open_spots = cut(open_spots.join(found, ["lat", "lon", "min_pts"], "left_anti"))
        if radius >= max_radius or open_spots.isEmpty():
            break
        radius = min(radius * 2, max_radius)
        radii = [radius]
        at = open_spots.select("lat", "lon").distinct().withColumn("eps_km", F.lit(float(radius)))
    endless = open_spots.select("lat", "lon", "w", "min_pts", F.lit(float("inf")).alias("km"))
    settled = settled.select("lat", "lon", "w", "min_pts", "km").unionByName(endless)
    distances = settled.groupBy("min_pts", "km").agg(F.sum("w").alias("n"))
    metre = -F.floor(F.col("km") * 1000)
    buckets = distances.groupBy("min_pts", metre.alias("_metre")).agg(F.sum("n").alias("_n"))
    earlier = Window.partitionBy("min_pts").orderBy("_metre").rowsBetween(Window.unboundedPreceding, -1)
    bases = buckets.select("min_pts", "_metre", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("min_pts", "_metre").orderBy(F.desc("km")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = distances.withColumn("_metre", metre).withColumn("_upto", F.sum("n").over(inside)).join(bases, ["min_pts", "_metre"])
    last = F.col("_base") + F.col("_upto")
    return ranked.select("min_pts", (last - F.col("n") + 1).alias("first_rank"), last.alias("last_rank"), F.when(F.col("km") < float("inf"), F.col("km")).alias("km"))


def _bounds(a: str, b: str) -> tuple[Column, Column]:
    """Least and greatest possible distance between the boxes with prefixes a and b.

    For two boxes that are single points both equal the exact distance.
    """
    def c(side, name):
        return F.col(f"{side}_{name}")

    def gap(name):
        return F.greatest(F.lit(0.0), c(a, f"{name}_lo") - c(b, f"{name}_hi"), c(b, f"{name}_lo") - c(a, f"{name}_hi"))

    def span(name):
        return F.greatest(F.abs(c(a, f"{name}_hi") - c(b, f"{name}_lo")), F.abs(c(b, f"{name}_hi") - c(a, f"{name}_lo")))

    def widest(side):
        lo, hi = c(side, "lat_lo"), c(side, "lat_hi")
        return F.cos(F.radians(F.greatest(F.lit(0.0), lo, -hi)))

    def narrowest(side):
        return F.cos(F.radians(F.greatest(F.abs(c(side, "lat_lo")), F.abs(c(side, "lat_hi")))))

    def km(dlat, dlon, cosines):
        x, y = F.sin(F.radians(dlat) / 2), F.sin(F.radians(dlon) / 2)
        h = F.least(F.lit(1.0), x * x + cosines * y * y)
        return 2 * CLUSTER_RADIUS_KM * F.asin(F.sqrt(h))

    # Longitudes differ by something from gap to span; beyond 180 degrees the way round is shorter.
    low, high = gap("lon"), span("lon")
    nearest = F.least(low, F.greatest(F.lit(0.0), 360.0 - high))
    farthest = F.when(high <= 180, high).when(low >= 180, 360.0 - low).otherwise(F.lit(180.0))
    return (
        km(gap("lat"), nearest, narrowest(a) * narrowest(b)),
        km(span("lat"), farthest, widest(a) * widest(b)),
    )


def _box_aggregates() -> list[Column]:
    return [
        F.min("lat").alias("lat_lo"), F.max("lat").alias("lat_hi"),
        F.min("lon").alias("lon_lo"), F.max("lon").alias("lon_hi"), F.count(F.lit(1)).alias("n"),
    ]


def _cell_edges(cores: DataFrame, direct_pairs: int) -> DataFrame:
    """(run, a, b): adjacent cells holding core spots within the radius of each other.

    Whole cells are compared by their bounding boxes; pairs that leave open whether some
    two spots are near are settled spot by spot when small, and otherwise by boxes sixteen
    times finer, again and again.  Spots of two crowded cells are therefore never paired
    off in full, yet the answer is exact: a box of one spot has an exact distance.
    """
    boxes = cut(cores.groupBy("run", "eps_km", *CELL).agg(F.min("first").alias("id"), *_box_aggregates()))
    values = ["id", "lat_lo", "lat_hi", "lon_lo", "lon_hi", "n"]
    ring = with_ring(boxes).select("run", "eps_km", F.col("ring_band").alias("band"), F.col("ring_col").alias("col"), *[F.col(v).alias(f"a_{v}") for v in values])
    other = boxes.select("run", *CELL, *[F.col(v).alias(f"b_{v}") for v in values])
    pairs = ring.join(other, ["run", *CELL]).where(F.col("a_id") < F.col("b_id"))

    def judged(df):
        least, greatest = _bounds("a", "b")
        return df.withColumns({"_least": least, "_greatest": greatest}).where(F.col("_least") <= F.col("eps_km"))

    level = cut(judged(pairs))
    sure = F.col("_greatest") <= F.col("eps_km")
    edges = level.where(sure).select("run", F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    unsure = level.where(~sure)
    spots = cores.join(boxes.select("run", *CELL, "id"), ["run", *CELL]).select("run", "id", "lat", "lon")
    spots = cut(spots)

    def side(name, df, keys):
        return df.select("run", *keys, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in ("run", *keys)])

    small = unsure.where(F.col("a_n") * F.col("b_n") <= direct_pairs).select("run", "eps_km", "a_id", "b_id")
    met = small.join(side("a", spots, []), ["run", "a_id"]).join(side("b", spots, []), ["run", "b_id"])
    exact = haversine(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"), radius=CLUSTER_RADIUS_KM)
    edges = edges.unionByName(
        met.where(exact <= F.col("eps_km")).select("run", F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()
    )
    rest = cut(unsure.where(F.col("a_n") * F.col("b_n") > direct_pairs).select("run", "eps_km", "a_id", "b_id"))
    parents, scale = [], 4.0
    while not rest.isEmpty():
        # Finer boxes of the cells still in question; their parents are the boxes judged before.
        indexed = spots.withColumns(
            {
                **{f"{x}_sup": F.floor(F.col(x) * (scale / 4)) for x in ("lat", "lon") if parents},
                **{f"{x}_sub": F.floor(F.col(x) * scale) for x in ("lat", "lon")},
            }
        )
        subs = indexed.groupBy("run", "id", *parents, "lat_sub", "lon_sub").agg(*_box_aggregates())
        a = subs.toDF(*[c if c == "run" else f"a_{c}" for c in subs.columns])
        b = subs.toDF(*[c if c == "run" else f"b_{c}" for c in subs.columns])
        finer = rest.join(a, ["run", "a_id", *[f"a_{p}" for p in parents]]).join(b, ["run", "b_id", *[f"b_{p}" for p in parents]])
        level = cut(judged(finer))
        found = level.where(sure).select("run", F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()
        edges = edges.unionByName(found)
        still = level.where(~sure).join(
            found.withColumnsRenamed({"a": "a_id", "b": "b_id"}), ["run", "a_id", "b_id"], "left_anti"
        )
        parents = ["lat_sup", "lon_sup"]
        rest = cut(
            still.select(
                "run", "eps_km", "a_id", "b_id",
                *[F.col(f"{s}_{x}_sub").alias(f"{s}_{x}_sup") for s in ("a", "b") for x in ("lat", "lon")],
            )
        )
        scale *= 4
    return edges


def _jump(hooks: DataFrame) -> DataFrame:
    """Follow every pointer one pointer further."""
    above = hooks.select("run", F.col("id").alias("up"), F.col("up").alias("_top"))
    return hooks.join(above, ["run", "up"]).select("run", "id", F.col("_top").alias("up"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(run, id, label): label is the least id connected to id.

    Every node points to its least neighbour, pointers are doubled until they end at roots,
    and the edges are rewritten between roots.  Pointers double and nodes at least halve,
    so the number of steps grows with the logarithm of the graph; each step is written out.
    """
    labels = nodes.select("run", "id", F.col("id").alias("label"))
    rest = cut(edges.distinct())
    while not rest.isEmpty():
        both = rest.unionByName(rest.select("run", F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = cut(both.groupBy("run", F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("up")))
        while True:
            twice = _jump(_jump(hooks)).withColumnRenamed("up", "_up")
            moved = cut(hooks.join(twice, ["run", "id"]).withColumn("moved", F.col("up") != F.col("_up")))
            hooks = moved.select("run", "id", F.col("_up").alias("up"))
            if moved.where("moved").isEmpty():
                break
        roots = hooks.withColumnRenamed("id", "label")
        labels = cut(labels.join(roots, ["run", "label"], "left").select("run", "id", F.coalesce("up", "label").alias("label")))
        ends = {e: hooks.select("run", F.col("id").alias(e), F.col("up").alias(f"_{e}")) for e in ("a", "b")}
        mapped = rest.join(ends["a"], ["run", "a"]).join(ends["b"], ["run", "b"]).where(F.col("_a") != F.col("_b"))
        rest = cut(mapped.select("run", F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
    return labels


def labelled_spots(df: DataFrame, runs: Sequence[tuple[float, int]], key: str = "track", direct_pairs: int = DIRECT_PAIRS) -> DataFrame:
    """(run, eps_km, min_pts, lat, lon, w, is_core, label) of every distinct position per run.

    ``label`` is the first key among the cluster's core points, or null for noise.  All
    parameter pairs go through the same jobs side by side.
    """
    params = F.array(
        *[F.struct(F.lit(i).alias("run"), F.lit(float(e)).alias("eps_km"), F.lit(int(m)).alias("min_pts")) for i, (e, m) in enumerate(runs)]
    )
    spots = cut(with_cell(_spots(df, key).select("*", F.inline(params))))
    by_cell = ["run", *CELL]
    weights = spots.groupBy(*by_cell, "min_pts").agg(F.sum("w").alias("cell_w"))
    dense = weights.where(F.col("cell_w") >= F.col("min_pts")).select(*by_cell, F.lit(True).alias("dense"))
    marked = cut(spots.join(dense, by_cell, "left").withColumn("dense", F.coalesce("dense", F.lit(False))))
    # Only spots of light cells, fewer than min_pts each, count their neighbours.
    light = marked.where(~F.col("dense")).select("run", "eps_km", "min_pts", *CELL, "lat", "lon", "first")
    around = radius_candidates(light, marked.select("run", *CELL, "lat", "lon", "w"), ["run"])
    counts = (
        around.where(_km() <= F.col("l_eps_km"))
        .groupBy("run", F.col("l_lat").alias("lat"), F.col("l_lon").alias("lon"))
        .agg(F.sum("r_w").alias("near"))
    )
    known = cut(
        marked.join(counts, ["run", "lat", "lon"], "left").withColumn(
            "is_core", F.col("dense") | F.coalesce(F.col("near") >= F.col("min_pts"), F.lit(False))
        )
    )
    cores = known.where("is_core").select("run", "eps_km", *CELL, "lat", "lon", "first")
    nodes = cores.groupBy(*by_cell).agg(F.min("first").alias("id"))
    labels = components(nodes, _cell_edges(cores, direct_pairs))
    core_cells = nodes.join(labels, ["run", "id"]).select(*by_cell, "label")
    labelled_cores = cores.join(core_cells, by_cell).select("run", *CELL, "lat", "lon", "label")
    # A border spot belongs to the lowest-numbered cluster with a core point in reach.
    border = known.where(~F.col("is_core")).select("run", "eps_km", *CELL, "lat", "lon")
    reached = (
        radius_candidates(border, labelled_cores, ["run"])
        .where(_km() <= F.col("l_eps_km"))
        .groupBy("run", F.col("l_lat").alias("lat"), F.col("l_lon").alias("lon"))
        .agg(F.min("r_label").alias("_border"))
    )
    own = known.join(core_cells, by_cell, "left").join(reached, ["run", "lat", "lon"], "left")
    label = F.when(F.col("is_core"), F.col("label")).otherwise(F.col("_border"))
    return own.select(*RUN, "lat", "lon", "w", "is_core", label.alias("label"))


def dbscan_runs(df: DataFrame, runs: Sequence[tuple[float, int]], key: str = "track", direct_pairs: int = DIRECT_PAIRS) -> DataFrame:
    """``df`` once per (eps_km, min_pts) with ``run``, ``is_core`` and ``cluster`` (-1 is noise).

    Clusters are numbered from 0 by their first core point in key order.
    """
    spots = cut(labelled_spots(df, runs, key, direct_pairs))
    names = spots.where(F.col("label").isNotNull()).select("run", "label").distinct()
    ranked = rank_in_buckets(names, F.floor(F.col("label") / 1e10), [F.col("label")], ["run"])
    numbered = ranked.select("run", "label", (F.col("rank") - 1).alias("cluster"))
    named = spots.join(numbered, ["run", "label"], "left").select(
        *RUN, "lat", "lon", "is_core", F.coalesce("cluster", F.lit(-1)).cast("bigint").alias("cluster")
    )
    # A position that lacks a coordinate is nobody's neighbour; its row stays, as noise of every run.
    spot = named.withColumnsRenamed({"lat": "_lat", "lon": "_lon"})
    at = df["lat"].eqNullSafe(spot["_lat"]) & df["lon"].eqNullSafe(spot["_lon"])
    return df.join(spot, at).drop("_lat", "_lon")


def dbscan(df: DataFrame, eps_km: float, min_pts: int, key: str = "track", direct_pairs: int = DIRECT_PAIRS) -> DataFrame:
    """``df`` with ``is_core`` and ``cluster``."""
    return dbscan_runs(df, [(eps_km, min_pts)], key, direct_pairs).drop(*RUN)


def cluster_bbox(df: DataFrame, by: Sequence[str] = ("cluster",)) -> DataFrame:
    """Bounding box of each cluster and its size in square kilometres; noise has none."""
    boxes = df.where(F.col("cluster") != -1).groupBy(*by).agg(
        *[f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for n, f in (("min", F.min), ("max", F.max))],
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("mmsi").alias("vessels"),
    )
    lat, lon = F.col("min_lat"), F.col("min_lon")
    width = haversine(lat, lon, lat, F.col("max_lon"))
    height = haversine(lat, lon, F.col("max_lat"), lon)
    return boxes.withColumns({"width_km": width, "height_km": height, "sq_km": width * height})


def cluster_metrics(labelled: DataFrame) -> DataFrame:
    """Quality of each run of :func:`dbscan_runs`: one row per (eps_km, min_pts)."""
    boxes = cluster_bbox(labelled, (*RUN, "cluster"))
    totals = labelled.groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(F.col("cluster") != -1).alias("_in")
    )
    sizes = boxes.groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.max("n").alias("_largest"), F.avg("n").alias("mean_size"),
        F.avg("vessels").alias("mean_vessels"), F.avg("sq_km").alias("mean_sq_km"),
    )
    joined = totals.join(sizes, list(RUN), "left")
    share = F.col("_all").cast("double")
    return joined.select(
        "eps_km",
        "min_pts",
        F.coalesce("n_clusters", F.lit(0)).alias("n_clusters"),
        (F.col("_in") / share).alias("clustered_share"),
        (F.coalesce("_largest", F.lit(0)) / share).alias("largest_share"),
        (F.col("mean_size") / share).alias("mean_cluster_share"),
        "mean_size",
        "mean_vessels",
        "mean_sq_km",
    )


def cluster_summary(labelled: DataFrame) -> DataFrame:
    """One row for one parameter pair: largest and noise share, count, mean size, mean area."""
    one = labelled.withColumns({"run": F.lit(0), "eps_km": F.lit(0.0), "min_pts": F.lit(0)})
    return cluster_metrics(one).select(
        "largest_share", (1 - F.col("clustered_share")).alias("noise_share"), "n_clusters", "mean_size", "mean_sq_km"
    )


def cluster_centers(labelled: DataFrame) -> DataFrame:
    """Mean position per label, noise included."""
    return labelled.groupBy("cluster").agg(
        F.avg("lat").alias("destination_cluster_lat_center"), F.avg("lon").alias("destination_cluster_lon_center")
    )


def assign_destination_nearest(df: DataFrame, labelled: DataFrame, eps_km: float) -> DataFrame:
    """Add ``cluster``: that of the nearest core point within ``eps_km``, else -1.

    A position whose own cell holds cores, with one cluster only in the cells around, needs
    no distances.  The others are compared with the cores near them.
    """
    at = F.lit(float(eps_km))
    cores = cut(with_cell(labelled.where("is_core").select("lat", "lon", "cluster").distinct().withColumn("eps_km", at)))
    spots = cut(with_cell(df.select("lat", "lon").distinct().withColumn("eps_km", at)))
    cells = cores.groupBy(*CELL).agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi"))
    ring = with_ring(spots.select(*CELL, "eps_km").distinct())
    around = ring.join(
        cells.withColumnsRenamed({"band": "ring_band", "col": "ring_col"}), ["ring_band", "ring_col"]
    ).groupBy(*CELL).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.bool_or((F.col("ring_band") == F.col("band")) & (F.col("ring_col") == F.col("col"))).alias("own"),
    )
    placed = cut(spots.join(around, list(CELL), "left"))
    plain = F.col("own") & (F.col("lo") == F.col("hi"))
    settled = placed.where(plain).select("lat", "lon", F.col("lo").alias("cluster"))
    open_spots = placed.where(F.col("lo").isNotNull() & ~plain).select("lat", "lon", "eps_km", *CELL)
    compared = (
        radius_candidates(open_spots, cores.select("lat", "lon", "cluster", *CELL))
        .withColumn("km", _km())
        .where(F.col("km") <= eps_km)
        .groupBy(F.col("l_lat").alias("lat"), F.col("l_lon").alias("lon"))
        .agg(F.min_by("r_cluster", F.struct("km", "r_cluster")).alias("cluster"))
    )
    found = settled.unionByName(compared)
    return df.join(found, ["lat", "lon"], "left").withColumn("cluster", F.coalesce("cluster", F.lit(-1)).cast("bigint"))


def assign_destination(df: DataFrame, model, centers: DataFrame) -> DataFrame:
    """Every row of a track gets the cluster predicted for its last row, and that cluster's center.

    ``model`` is one of :func:`keelson.operators.destinations.fit_destination_model`.  No row is lost: a cluster without
    a center has null coordinates, a track without a final position is noise.
    """
    last = final_messages(df).select("track", "lat", "lon")
    predicted = model.transform(last).join(centers, "cluster", "left")
    named = predicted.withColumn("destination_cluster", F.col("cluster").cast("string")).drop("cluster")
    return df.join(named, "track", "left")
