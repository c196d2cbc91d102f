"""Model features of rows: selection of steps, clock, currents, columns, scaling.

Features of whole windows are in ``window_features``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.config import CATEGORICAL_COLUMNS, Box, Config
from keelson.functions.clock import local_stamp
from keelson.functions.ordered import shuffled_rank
from keelson.operators.windows import x_steps, y_steps

KEY = ("track", "window_id")
# The zone hours and weekdays are read in, neighbour counts, bins (column, size, cutoff),
# and the words whose columns share one normalization range.
LOCAL_ZONE = "America/Los_Angeles"
NEAREST_COUNTS = (50, 25, 10, 5, 1)
NEAREST_ARRAY = 35
BINS = (
    ("sog", 4, 16),
    ("cog", 60, None),
    ("mean_bearing_angle", 60, None),
    ("std_bearing_angle", 30, None),
    ("distance_traveled", 10, 70),
    ("water_u_mean", 50, 300),
    ("water_u_std", 50, 300),
    ("water_v_mean", 50, 300),
    ("water_v_std", 50, 300),
    ("mean_current_magnitude", 50, 400),
    ("std_current_magnitude", 50, 300),
)
SHARED_RANGE_WORDS = ("speed", "water", "mmsi_neighbor", "lat_neighbor", "lon_neighbor", "time_since_neighbor")


def history_steps(cfg: Config, hours: float, gap: int) -> list[int]:
    """The steps of the last hours of the history part at a time gap; more than there is raises."""
    wanted, steps = int(hours * 3600 / gap + 1), x_steps(cfg, gap)
    if wanted > len(steps):
        raise ValueError(f"{wanted} history steps asked for, the windows hold {len(steps)}")
    return steps[-wanted:]


def select_history(df: DataFrame, cfg: Config, hours: float, gap: int) -> DataFrame:
    """Keep the last hours of the history part at a time gap."""
    return df.where(F.col("step").isin(history_steps(cfg, hours, gap)))


def target_index(cfg: Config, hours_out: float, gap: int) -> int:
    """Which of the future steps at a time gap lies ``hours_out`` ahead; one beyond the windows raises."""
    index = round(hours_out * 3600 / gap) - 1
    if not 0 <= index < len(y_steps(cfg, gap)):
        raise ValueError(f"no future step {hours_out} hours ahead at a gap of {gap} seconds")
    return index


def target_steps(cfg: Config, gap: int, hours_out: float, model: str = "direct", test: bool = False) -> list[int]:
    """Future steps a model is scored on: one (direct), the first (iterative) or all (iterative, test)."""
    steps = y_steps(cfg, gap)
    if model == "direct":
        return [steps[target_index(cfg, hours_out, gap)]]
    return steps[:1] if model == "iterative" and not test else steps


def select_target(df: DataFrame, cfg: Config, gap: int, hours_out: float, model: str = "direct", test: bool = False):
    """Future rows a model is scored on."""
    return df.where(F.col("step").isin(target_steps(cfg, gap, hours_out, model, test)))


def with_local_time(df: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Add ``hour`` and ``day_of_week`` (Monday 0) of the local clock, daylight saving included."""
    local = local_stamp(F.col("base_datetime"), zone)
    return df.withColumns({"hour": F.hour(local), "day_of_week": F.weekday(local.cast("date"))})


def _sums(values: Column) -> Column:
    """Count, sum and sum of squares of the non-null values, in one pass over the array."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))

    def add(total, x):
        return F.struct((total["n"] + 1).alias("n"), (total["s"] + x).alias("s"), (total["q"] + x * x).alias("q"))

    return F.aggregate(F.filter(values, lambda x: x.isNotNull()), zero, add)


def mean_of(values: Column) -> Column:
    return _finish(values, lambda t: F.try_divide(t["s"], t["n"]))


def _finish(values: Column, result) -> Column:
    """``result`` of the sums, computed once."""
    return F.transform(F.array(_sums(values)), result)[0]


def _deviation(total: Column) -> Column:
    return F.greatest(F.lit(0.0), total["n"] * total["q"] - total["s"] * total["s"])


def std_pop_of(values: Column) -> Column:
    return _finish(values, lambda t: F.try_divide(F.sqrt(_deviation(t)), t["n"]))


def std_samp_of(values: Column) -> Column:
    return _finish(values, lambda t: F.sqrt(F.try_divide(F.try_divide(_deviation(t), t["n"]), t["n"] - 1)))


def _component(name: str, currents: str = "currents") -> Column:
    return F.transform(F.col(currents), lambda c: c[name].cast("double"))


def magnitude(cell: Column) -> Column:
    u, v = cell["u"].cast("double"), cell["v"].cast("double")
    return F.sqrt(u * u + v * v)


def pack_wide(df: DataFrame) -> DataFrame:
    """Gather the wide current columns of a row into one ``currents`` array."""
    cells = sorted({c[: -len("_water_u")] for c in df.columns if c.endswith("_water_u")})
    entry = [
        F.struct(
            F.lit(float(name.split("_")[0])).alias("lat"),
            F.lit(float(name.split("_")[1])).alias("lon"),
            F.col(f"`{name}_water_u`").alias("u"),
            F.col(f"`{name}_water_v`").alias("v"),
        )
        for name in cells
        if f"{name}_water_v" in df.columns
    ]
    wide = [c for c in df.columns if c.endswith(("_water_u", "_water_v"))]
    return df.withColumn("currents", F.array(*entry)).drop(*wide)


def with_component_stats(df: DataFrame) -> DataFrame:
    """Mean size and population deviation of u and of v over the grid."""
    out = {}
    for name in ("u", "v"):
        values = _component(name)
        out[f"water_{name}_mean"] = mean_of(F.transform(values, F.abs))
        out[f"water_{name}_std"] = std_pop_of(values)
    return df.withColumns(out)


def with_magnitude_stats(df: DataFrame) -> DataFrame:
    """Mean and population deviation of the current speed over the grid."""
    values = F.transform(F.col("currents"), magnitude)
    return df.withColumns({"mean_current_magnitude": mean_of(values), "std_current_magnitude": std_pop_of(values)})


def describe_currents(df: DataFrame) -> DataFrame:
    """Every statistic that depends on the currents alone, and the speeds by cell; apply it to stamps, not messages."""
    return with_magnitude_stats(with_component_stats(df)).withColumn("speeds", F.transform("currents", magnitude))


def undo_one_hot(df: DataFrame, prefix: str) -> DataFrame:
    """Boolean columns ``{prefix}_{level}`` back to one text column ``prefix``."""
    columns = [c for c in df.columns if c.startswith(f"{prefix}_") and dict(df.dtypes)[c] == "boolean"]
    texts = [F.when(F.col(f"`{c}`"), F.lit(c[len(prefix) + 1 :])) for c in columns]
    return df.withColumn(prefix, F.concat_ws("", *texts)).drop(*columns)


def bin_label(column: Column, size: int, cutoff: int | None) -> Column:
    """``[a, b)`` of the bin holding the value, or ``[cutoff+]`` from the cutoff on."""
    low = (F.floor(column / size) * size).cast("int")
    label = F.concat(F.lit("["), low.cast("string"), F.lit(", "), (low + size).cast("string"), F.lit(")"))
    return label if cutoff is None else F.when(low < cutoff, label).when(low.isNotNull(), F.lit(f"[{cutoff}+]"))


def with_bins(df: DataFrame, bins=BINS) -> DataFrame:
    return df.withColumns({f"{c}_bin": bin_label(F.col(c), size, cutoff) for c, size, cutoff in bins})


def group_of(column: str) -> str | None:
    """Feature group of a column: weather, a categorical prefix, or none."""
    group = None
    if column in ("weather_is_imputed", "time_since_weather_obs") or "water_" in column:
        group = "weather"
    for prefix in CATEGORICAL_COLUMNS:
        if prefix in column:
            group = prefix
    return group


def column_catalogue(df: DataFrame) -> DataFrame:
    """(original_index, column, dtype, column_group, being_used, filled) of every feature.

    ``filled`` counts the rows with a value, all columns in one pass.
    """
    entries = [
        F.struct(
            F.lit(i).alias("original_index"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("dtype"),
            F.lit(group_of(name)).cast("string").alias("column_group"),
            F.lit(True).alias("being_used"),
            F.count(F.col(f"`{name}`")).alias("filled"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return df.agg(F.array(*entries).alias("_entries")).select(F.inline("_entries"))


def drop_groups(df: DataFrame, weather: str = "ignore", destination: str = "ignore", sog_cog: str = "raw") -> DataFrame:
    """Drop the feature groups a run leaves out, and always the time column.

    ``destination`` is 'ignore', 'ohe' (drop the centers) or 'cluster_centers' (drop the
    one-hot columns); ``weather`` and ``sog_cog`` take 'ignore'.
    """
    types = dict(df.dtypes)
    gone = ["base_datetime"]
    if sog_cog == "ignore":
        gone += ["sog", "cog"]
    if weather == "ignore":
        gone += [c for c in df.columns if group_of(c) == "weather"]
    members = [c for c in df.columns if group_of(c) == "destination_cluster"]
    if destination == "ignore":
        gone += members
    elif destination == "ohe":
        gone += [c for c in members if c.endswith("_center")]
    elif destination == "cluster_centers":
        gone += [c for c in members if types[c] == "boolean"]
    return df.drop(*gone)


def fit_normalizer(df: DataFrame, box: Box, years: Sequence[int], columns: Sequence[str]) -> DataFrame:
    """(column, min, max) per feature, from one aggregate over the training rows.

    Position, year and month take their known ranges; columns sharing a word share the
    widest range among them.
    """
    types = dict(df.dtypes)
    known = {
        "lat": (box.lat_1, box.lat_2),
        "lon": (box.lon_1, box.lon_2),
        "year": (min(years), max(years)),
        "month": (1, 12),
    }
    measured = [c for c in columns if c not in known and types[c] != "boolean"]
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high"))
        for c, (a, b) in known.items()
        if c in columns
    ] + [
        F.struct(
            F.lit(c).alias("column"),
            F.min(F.col(f"`{c}`")).cast("double").alias("low"),
            F.max(F.col(f"`{c}`")).cast("double").alias("high"),
        )
        for c in measured
    ]
    ranges = df.agg(F.array(*entries).alias("_r")).select(F.inline("_r"))
    # The last matching word decides, and a column matching none keeps its own range.
    word = reduce(
        lambda rest, w: F.when(F.contains("column", F.lit(w)), F.lit(w)).otherwise(rest), SHARED_RANGE_WORDS, F.col("column")
    )
    word = F.when(F.col("column").isin(*known), F.col("column")).otherwise(word)
    family = Window.partitionBy("_word")
    return (
        ranges.withColumn("_word", word)
        .withColumns({"min": F.min("low").over(family), "max": F.max("high").over(family)})
        .select("column", "min", "max")
    )


def factors(fitted: DataFrame) -> dict[str, tuple[float, float]]:
    """The fitted ranges on the driver: one entry per feature column."""
    return {r["column"]: (r["min"], r["max"]) for r in fitted.collect()}


def normalize(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Scale to 0..1; a column that does not vary becomes 0."""
    scaled = {}
    for c, (low, high) in ranges.items():
        if c in df.columns:
            x = F.col(f"`{c}`")
            scaled[c] = (x - low) / (high - low) if high != low else F.when(x.isNotNull(), F.lit(0.0))
    return df.withColumns(scaled)


def unnormalize(df: DataFrame, ranges: Mapping[str, tuple[float, float]], columns: Sequence[str] | None = None) -> DataFrame:
    """Scale back to original units."""
    columns = [c for c in (columns or ranges) if c in df.columns]
    return df.withColumns(
        {c: F.col(f"`{c}`") * (ranges[c][1] - ranges[c][0]) + ranges[c][0] for c in columns}
    )


def recurrent_columns(df: DataFrame, choice: str, sog_cog: str = "raw", time_of_day: str = "hour_day") -> list[str]:
    """Columns the recurrent half of a fusion model reads."""
    features = [c for c in df.columns if c not in (*KEY, "step")]
    if choice == "all_non_weather":
        return [c for c in features if group_of(c) != "weather"]
    out = ["lat", "lon"] + (["sog", "cog"] if sog_cog == "raw" else [])
    if choice == "vt_dst_and_time":
        out += [c for c in features if group_of(c) in CATEGORICAL_COLUMNS]
        out += ["hour", "day_of_week"] if time_of_day == "hour_day" else []
    return out


def fusion_split(df: DataFrame, recurrent: Sequence[str], last: int) -> tuple[DataFrame, DataFrame]:
    """(recurrent columns of every step, the other columns of the last step only)."""
    others = [c for c in df.columns if c not in {*KEY, "step", *recurrent}]
    return (
        df.select(*KEY, "step", *[f"`{c}`" for c in recurrent]),
        df.where(F.col("step") == last).select(*KEY, *[f"`{c}`" for c in others]),
    )


def weather_grid(df: DataFrame, frame: DataFrame) -> DataFrame:
    """Add ``grid``: longitudes descending x latitudes ascending x (u, v, mask).

    ``frame`` is one row with the arrays ``lats`` and ``lons`` of the grid.  A cell without
    currents is land: 0.5, 0.5, 1; otherwise the mask is 0.5 on imputed rows and 0 on others.
    """
    cells = F.map_from_entries(
        F.transform("currents", lambda c: F.struct(F.struct(c["lat"], c["lon"]), F.struct(c["u"].cast("double"), c["v"].cast("double"))))
    )

    def cell(lat, lon):
        found = F.try_element_at(F.col("_cells"), F.struct(lat.alias("lat"), lon.alias("lon")))
        mask = F.when(found.isNull(), F.lit(1.0)).when(F.col("weather_is_imputed"), F.lit(0.5)).otherwise(F.lit(0.0))
        return F.array(F.coalesce(found["col1"], F.lit(0.5)), F.coalesce(found["col2"], F.lit(0.5)), mask)

    grid = F.transform("_lons", lambda lon: F.transform("_lats", lambda lat: cell(lat, lon)))
    shape = frame.select(F.array_sort("lats").alias("_lats"), F.sort_array("lons", asc=False).alias("_lons"))
    return (
        df.join(F.broadcast(shape), F.lit(True)).withColumn("_cells", cells).withColumn("grid", grid)
        .drop("_cells", "_lats", "_lons")
    )


def grid_frame(cells: DataFrame) -> DataFrame:
    """The one-row frame of :func:`weather_grid`: distinct lines of the current grid."""
    return cells.agg(F.collect_set("lat").alias("lats"), F.collect_set("lon").alias("lons"))


def target_names(model: str = "direct", sog_cog: str = "raw") -> list[str]:
    return ["lat", "lon"] + (["sog", "cog"] if sog_cog == "raw" and model == "iterative" else [])


def select_targets(df: DataFrame, model: str = "direct", sog_cog: str = "raw") -> DataFrame:
    """Columns a model predicts; one-step targets lose the step axis."""
    axis = [] if model == "direct" else ["step"]
    return df.select(*KEY, *axis, *target_names(model, sog_cog))


def head_sample(df: DataFrame, n: int) -> DataFrame:
    """The first n windows in key order: small inputs for debugging."""
    first = df.select(*KEY).distinct().orderBy(*KEY).limit(n)
    return df.join(first, list(KEY), "left_semi")


def epoch_batches(df: DataFrame, size: int, seed: str, epoch: int = 0, drop_remainder: bool = False) -> DataFrame:
    """Shuffle windows for an epoch and number them into batches; the last may be smaller, or is left out if asked for."""
    key = F.concat_ws("|", *KEY)
    ranked = shuffled_rank(df.select(*KEY).distinct(), f"{seed}|{epoch}", key)
    numbered = ranked.withColumn("batch", F.floor((F.col("rank") - 1) / size))
    full = F.floor(F.col("total") / size)
    return (numbered.where(F.col("batch") < full) if drop_remainder else numbered).drop("rank", "total")


def dataset_shapes(df: DataFrame, features: int, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Sequences, steps and features of each dataset."""
    windows = df.groupBy(*by, *KEY).agg(F.count(F.lit(1)).alias("_steps"))
    return windows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sequences"), F.max("_steps").alias("steps"), F.lit(features).alias("features")
    )
