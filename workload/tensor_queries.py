"""Model input written and read back: windows with positions, one-hot groups and currents."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.storage import cut, work_folder
from keelson.operators import clustering, resample
from keelson.plans import tensors as tensor_plan
from workload import inputs
from workload.feature_queries import packed
from workload.inputs import CFG
from workload.registry import big, cte, q4, q4_sql, query

FEATURES = ["base_datetime", "lat", "lon", "sog", "cog"]
cte(
    "tensor_rows",
    """select dataset, 3600 as time_gap, 'x' as x_or_y, track, window_id, step, base_datetime, lat, lon, sog, cog from dataset_rows where step < 5
      union all select dataset, 3600, 'y', track, window_id, step, base_datetime, lat, lon, sog, cog from dataset_rows where step >= 5
      union all select dataset, 7200, 'x', track, window_id, step, base_datetime, lat, lon, sog, cog from dataset_rows where step in (0, 2, 4)
      union all select dataset, 7200, 'y', track, window_id, step, base_datetime, lat, lon, sog, cog from dataset_rows where step in (6, 8)""",
)


# Levels of the one-hot columns, and the position of a row's own among them (0: not in the training rows).
CATEGORIES = ["vessel_group", "destination_cluster"]
cte("final_clusters", "select r.*, cast(c.cluster as varchar) as destination_cluster from resampled r join grouped_1 c using (track)")
for _name in CATEGORIES:
    cte(
        f"{_name}_codes",
        f"select distinct {_name}, dense_rank() over (order by {_name}) as code from (select distinct {_name} from final_clusters where split = 'train')",
    )
cte("row_water", "select track, base_datetime, cast(sum(u) as bigint) as water_u, cast(sum(v) as bigint) as water_v from row_cells group by track, base_datetime")


def write_full_tensors(spark, sf):
    """All windows with positions, vessel group, destination (cluster of the track's last position) and currents."""
    long = inputs.long_tracks(spark, sf)
    labels = clustering.dbscan(cut(clustering.final_messages(long)), inputs.EPS_KM, inputs.MIN_PTS)
    named = labels.select("track", F.col("cluster").alias("destination_cluster"))
    rows = cut(resample.interpolate_tracks(inputs.split_tracks(spark, sf, long), CFG).join(named, "track"))
    folder = work_folder(spark, "tensors")
    return folder, tensor_plan.write_full(rows, folder, CFG, FEATURES, CATEGORIES, cut(packed(spark, sf)))


@query(
    "tensor_sink",
    """select dataset, cast(time_gap as bigint) as time_gap, x_or_y, count(*) as sequences, cast(max(n) as bigint) as steps,
        5 + (select count(*) from vessel_group_codes) + (select count(*) from destination_cluster_codes) + 2 * (select count(*) from mean_cells) as features
      from (select dataset, time_gap, x_or_y, track, window_id, count(*) as n from tensor_rows group by all) group by all""",
)
def _(spark, sf):
    _, shapes = write_full_tensors(spark, sf)
    return shapes.select("dataset", *big("time_gap"), "x_or_y", *big("sequences", "steps", "features"))


@query(
    "tensor_source",
    f"""select t.track, t.window_id, cast(row_number() over (partition by t.track, t.window_id order by t.step) - 1 as bigint) as at,
      cast(t.base_datetime as bigint) as seconds, {q4_sql('t.lat')} as lat, {q4_sql('t.lon')} as lon, {q4_sql('t.sog')} as sog, {q4_sql('t.cog')} as cog,
      coalesce(g.code, 0) as vessel_group, coalesce(d.code, 0) as destination_cluster, w.water_u, w.water_v
      from tensor_rows t join final_clusters f on f.track = t.track and f.base_datetime = t.base_datetime
      join row_water w on w.track = t.track and w.base_datetime = t.base_datetime
      left join vessel_group_codes g on g.vessel_group = f.vessel_group left join destination_cluster_codes d on d.destination_cluster = f.destination_cluster
      where t.dataset = 'valid_long_term_train' and t.time_gap = 7200 and t.x_or_y = 'x'""",
)
def _(spark, sf):
    folder, _ = write_full_tensors(spark, sf)
    part = tensor_plan.read_full(spark, folder, "valid_long_term_train", 7200, "x", CATEGORIES)
    steps = part.select("track", "window_id", F.posexplode("sequence").alias("at", "row"))
    spans = {r["column"]: (r["first"], r["n"]) for r in tensor_plan.layout(spark, folder, FEATURES, CATEGORIES).groupBy("column").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n")).collect()}

    def span(name):
        return F.slice("row", spans[name][0] + 1, spans[name][1])

    own = {name: F.col("row")[spans[name][0]] for name in FEATURES}
    codes = [F.array_position(span(c), 1.0).alias(c) for c in CATEGORIES]
    sums = [F.aggregate(span(c), F.lit(0.0), lambda a, x: a + x).cast("bigint").alias(c) for c in ("water_u", "water_v")]
    return steps.select(
        "track", "window_id", *big("at"), own["base_datetime"].cast("bigint").alias("seconds"),
        *[q4(own[c]).alias(c) for c in ("lat", "lon", "sog", "cog")], *codes, *sums,
    )
