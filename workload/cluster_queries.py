"""Destination inference by density clustering of final positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.storage import cut
from keelson.operators import clustering, destinations
from workload import inputs
from workload.inputs import CLUSTER_RUNS, EPS_KM, MIN_PTS
from workload.registry import big, cte, haversine_sql, q4, q4_sql, query

cte(
    "finals",
    """select track, arg_max(mmsi, (base_datetime, event_id)) as mmsi, arg_max(lat, (base_datetime, event_id)) as lat,
      arg_max(lon, (base_datetime, event_id)) as lon from long_rows group by track""",
)
KM = haversine_sql("a.lat", "a.lon", "b.lat", "b.lon", "6371")
cte("pair_km", f"select a.track as a, b.track as b, {KM} as km from finals a, finals b")


def dbscan_ctes(name, eps, min_pts):
    """Core points, reachability between them, border points, numbering."""
    cte(f"{name}_near", f"select a, b from pair_km where km <= {eps}")
    cte(f"{name}_core", f"select a as track from {name}_near group by a having count(*) >= {min_pts}")
    cte(f"{name}_link", f"select a, b from {name}_near where a in (select track from {name}_core) and b in (select track from {name}_core)")
    cte(f"{name}_reach", f"select track as a, track as b from {name}_core union select r.a, l.b from {name}_reach r join {name}_link l on l.a = r.b")
    cte(f"{name}_label", f"select a as track, min(b) as label from {name}_reach group by a")
    cte(
        f"{name}",
        f"""select f.*, c.track is not null as is_core, coalesce(n.cluster, -1) as cluster from finals f
          left join {name}_core c using (track)
          left join (select n.a as track, min(l.label) as label from {name}_near n join {name}_label l on l.track = n.b group by n.a) e using (track)
          left join (select label, dense_rank() over (order by label) - 1 as cluster from (select distinct label from {name}_label)) n
            on n.label = coalesce((select l.label from {name}_label l where l.track = f.track), e.label)""",
    )


for _i, (_eps, _min) in enumerate(CLUSTER_RUNS):
    dbscan_ctes(f"grouped_{_i}", _eps, _min)


def finals(spark, sf):
    return cut(clustering.final_messages(inputs.long_tracks(spark, sf)))


def labelled(spark, sf):
    return cut(clustering.dbscan(finals(spark, sf), EPS_KM, MIN_PTS))


@query("final_messages", f"select track, mmsi, lat, lon, {q4_sql('radians(lat)')} as lat_rad, {q4_sql('radians(lon)')} as lon_rad from finals")
def _(spark, sf):
    out = finals(spark, sf)
    return out.withColumns({"lat_rad": q4(F.col("lat_rad")), "lon_rad": q4(F.col("lon_rad"))})


@query("cap_sample", "select track, lat, lon from finals order by md5('4148846|' || track), track limit 200")
def _(spark, sf):
    return clustering.cap_sample(finals(spark, sf), 200).select("track", "lat", "lon")


@query(
    "knn_distance_curve",
    f"""select m as min_pts, rank, {q4_sql('km')} as km from (
      select m, km, row_number() over (partition by m order by km desc) as rank from (
        select a, km, row_number() over (partition by a order by km) as nth from pair_km), (select unnest([2, 4, 10]) as m)
      where nth = m - 1)""",
)
def _(spark, sf):
    curve = clustering.knn_distance_curve(finals(spark, sf), (2, 4, 10), 10.0)
    ranks = curve.withColumn("rank", F.explode(F.sequence("first_rank", "last_rank")))
    return ranks.select("min_pts", *big("rank"), q4(F.col("km")).alias("km"))


@query("radius_neighbours", f"select a, b, {q4_sql('km')} as km from pair_km where a < b and km <= {EPS_KM}")
def _(spark, sf):
    out = clustering.radius_neighbours(finals(spark, sf), EPS_KM)
    return out.select("a", "b", q4(F.col("km")).alias("km"))


@query("dbscan", "select track, lat, lon, is_core, cast(cluster as bigint) as cluster from grouped_1")
def _(spark, sf):
    return labelled(spark, sf).select("track", "lat", "lon", "is_core", "cluster")


_BOX_COLUMNS = ["width_km", "height_km", "sq_km"]


def _box_sql(name):
    width = haversine_sql("min(lat)", "min(lon)", "min(lat)", "max(lon)")
    height = haversine_sql("min(lat)", "min(lon)", "max(lat)", "min(lon)")
    return f"""select cast(cluster as bigint) as cluster, min(lat) as min_lat, max(lat) as max_lat, min(lon) as min_lon, max(lon) as max_lon,
      count(*) as n, count(distinct mmsi) as vessels, {width} as width_km, {height} as height_km, {width} * {height} as sq_km
      from {name} where cluster <> -1 group by cluster"""


for _i in range(len(CLUSTER_RUNS)):
    cte(f"boxes_{_i}", _box_sql(f"grouped_{_i}"))
_METRICS = ["clustered_share", "largest_share", "mean_cluster_share", "mean_size", "mean_vessels", "mean_sq_km"]


def _metric_sql(i, eps, min_pts):
    total = f"(select cast(count(*) as double) from grouped_{i})"
    values = {
        "clustered_share": f"coalesce(sum(n), 0) / {total}",
        "largest_share": f"coalesce(max(n), 0) / {total}",
        "mean_cluster_share": f"avg(n) / {total}",
        "mean_size": "avg(n)",
        "mean_vessels": "avg(vessels)",
        "mean_sq_km": "avg(sq_km)",
    }
    columns = ", ".join(f"{q4_sql(v)} as {c}" for c, v in values.items())
    return f"select cast({eps} as double) as eps_km, cast({min_pts} as bigint) as min_pts, count(*) as n_clusters, {columns} from boxes_{i}"


@query("cluster_metrics", " union all ".join(_metric_sql(i, e, m) for i, (e, m) in enumerate(CLUSTER_RUNS)))
def _(spark, sf):
    out = clustering.cluster_metrics(cut(clustering.dbscan_runs(finals(spark, sf), CLUSTER_RUNS)))
    return out.select("eps_km", *big("min_pts", "n_clusters"), *[q4(F.col(c)).alias(c) for c in _METRICS])


@query("cluster_bbox", f"select * replace ({', '.join(f'{q4_sql(c)} as {c}' for c in _BOX_COLUMNS)}) from boxes_1")
def _(spark, sf):
    return clustering.cluster_bbox(labelled(spark, sf)).withColumns({c: q4(F.col(c)) for c in _BOX_COLUMNS})


@query(
    "cluster_centers",
    f"""select cast(cluster as bigint) as cluster, {q4_sql('avg(lat)')} as destination_cluster_lat_center,
      {q4_sql('avg(lon)')} as destination_cluster_lon_center from grouped_1 group by cluster""",
)
def _(spark, sf):
    names = ["destination_cluster_lat_center", "destination_cluster_lon_center"]
    return clustering.cluster_centers(labelled(spark, sf)).withColumns({c: q4(F.col(c)) for c in names})


_SUMMARY = ["largest_share", "noise_share", "mean_size", "mean_sq_km"]


@query(
    "cluster_summary",
    f"""select count(*) as n_clusters, {q4_sql('max(n) / (select cast(count(*) as double) from grouped_1)')} as largest_share,
      {q4_sql('(select avg(case when cluster = -1 then 1 else 0 end) from grouped_1)')} as noise_share,
      {q4_sql('avg(n)')} as mean_size, {q4_sql('avg(sq_km)')} as mean_sq_km from boxes_1""",
)
def _(spark, sf):
    out = clustering.cluster_summary(labelled(spark, sf))
    return out.select(*big("n_clusters"), *[q4(F.col(c)).alias(c) for c in _SUMMARY])


def holdout(spark, sf):
    """The model and its report, with 100 points held out: the tables are small here."""
    return destinations.fit_destination_model(labelled(spark, sf), holdout=100)


@query(
    "destination_classifier",
    "select least(count(*), 100) as tested, true as accurate, true as noise_counted, greatest(count(*) - 100, 0) as fitted, greatest(count(*) - 100, 0) as oob_rows, true as oob_near_held_out from finals",
)
def _(spark, sf):
    accurate = F.col("correct") >= 0.9 * F.col("tested")
    noise = F.col("wrong_with_noise") <= F.col("tested") - F.col("correct")
    model, report = holdout(spark, sf)
    fitted = model.forests.agg(F.sum("rows").alias("fitted"))
    return report.join(fitted, F.lit(True)).select(
        *big("tested"), accurate.alias("accurate"), noise.alias("noise_counted"), *big("fitted"),
        *big("oob_rows"), (F.abs(F.col("oob_accuracy") - F.col("accuracy")) <= 0.1).alias("oob_near_held_out"),
    )


@query(
    "assign_destination",
    """select count(*) as n_rows, count(distinct track) as n_tracks, true as one_destination_a_track, true as near_the_nearest,
      count(*) as with_center, true as at_its_center from long_rows""",
)
def _(spark, sf):
    """No row lost, one destination a track, and nine tracks of ten where the nearest core point says."""
    points = labelled(spark, sf)
    model, _report = destinations.fit_destination_model(points, holdout=100)
    rows = inputs.long_tracks(spark, sf)
    placed = clustering.assign_destination(rows, model, clustering.cluster_centers(points))
    nearest = clustering.assign_destination_nearest(finals(spark, sf), points, EPS_KM).select("track", "cluster")
    center = F.struct("destination_cluster_lat_center", "destination_cluster_lon_center")
    tracks = placed.groupBy("track").agg(
        F.count(F.lit(1)).alias("n"), F.min("destination_cluster").alias("lo"), F.max("destination_cluster").alias("hi"),
        F.count("destination_cluster_lat_center").alias("centered"), F.min(center).alias("center"), F.max(center).alias("last_center"),
    ).join(nearest, "track", "left")
    means = points.groupBy(F.col("cluster").cast("string").alias("lo")).agg(F.avg("lat").alias("mean_lat"), F.avg("lon").alias("mean_lon"))
    tracks = tracks.join(means, "lo", "left")
    there = (F.col("center") == F.col("last_center")) & (F.abs(F.col("center")["destination_cluster_lat_center"] - F.col("mean_lat")) < 1e-9)
    there = there & (F.abs(F.col("center")["destination_cluster_lon_center"] - F.col("mean_lon")) < 1e-9)
    agrees = F.avg(F.col("lo").eqNullSafe(F.col("cluster").cast("string")).cast("double")) >= 0.9
    return tracks.agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_tracks"),
        F.bool_and(F.col("lo") == F.col("hi")).alias("one_destination_a_track"), agrees.alias("near_the_nearest"),
        F.sum("centered").alias("with_center"), F.bool_and(there).alias("at_its_center"),
    )


cte(
    "message_nearest",
    f"""select m.event_id, arg_min(c.cluster, ({KM.replace('a.', 'm.').replace('b.', 'c.')}, c.cluster)) as cluster
      from tracked m join grouped_1 c on c.is_core and {KM.replace('a.', 'm.').replace('b.', 'c.')} <= {EPS_KM} group by m.event_id""",
)


@query("assign_destination_nearest", "select event_id, cast(coalesce(n.cluster, -1) as bigint) as cluster from tracked left join message_nearest n using (event_id)")
def _(spark, sf):
    from keelson.operators.tracks import assign_tracks

    rows = assign_tracks(inputs.valid(spark, sf), inputs.CFG)
    return clustering.assign_destination_nearest(rows, labelled(spark, sf), EPS_KM).select("event_id", "cluster")
