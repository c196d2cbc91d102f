"""Ocean currents: thinning the grid, shaping it, joining it to messages, filling gaps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.config import Box
from keelson.functions.clock import day_of_month, hour_of, month_of, year_of
from keelson.functions.storage import cut

# Stamp columns, target grid size, null share beyond which a cell is dropped, scale.
STAMP = ("year", "month", "day", "hour")
GRID_DIM = 14
MAX_NULL_SHARE = 0.5
INT_SCALE = 1000
STAMP_HOURS = 3


def currents_bbox(df: DataFrame, box: Box) -> DataFrame:
    """Cells inside the box, edges included."""
    return df.where(
        F.col("latitude").between(box.lat_1, box.lat_2) & F.col("longitude").between(box.lon_1, box.lon_2)
    )


def _kept_axis(df: DataFrame, column: str, dim: int) -> DataFrame:
    """Every stride-th value of one grid axis, stride = round-half-even(n / (dim - 1)).

    An axis has as many values as the grid has lines, whatever the number of stamps; what
    is kept is at most about 1.5 * dim values, so it may be broadcast.
    """
    axis = df.agg(F.array_sort(F.collect_set(column)).alias("_axis"))
    stride = F.greatest(F.lit(1), F.bround(F.size("_axis") / F.lit(float(dim - 1)), 0).cast("int"))
    picked = axis.withColumn("_stride", stride).select(F.posexplode("_axis").alias("_i", column), "_stride")
    return picked.where(F.col("_i") % F.col("_stride") == 0).select(column)


def thin_grid(df: DataFrame, dim: int = GRID_DIM) -> DataFrame:
    """Keep about dim x dim grid cells, and of those the rows with a speed."""
    out = df.where(F.col("speed").isNotNull())
    for column in ("latitude", "longitude"):
        out = out.join(F.broadcast(_kept_axis(df, column, dim)), column, "left_semi")
    return out


def coord_key(lat, lon) -> Column:
    """Text name of a cell, e.g. ``26.03_-85.4``."""
    return F.concat(F.round(lat, 2).cast("string"), F.lit("_"), F.round(lon, 2).cast("string"))


def with_coord(df: DataFrame) -> DataFrame:
    return df.withColumn("coord", coord_key(F.col("latitude"), F.col("longitude")))


def drop_sparse(df: DataFrame, max_null_share: float = MAX_NULL_SHARE) -> DataFrame:
    """Drop cells absent from more than the given share of the stamps (land, sporadic reports)."""
    stamps = df.agg(F.count_distinct(*STAMP).alias("_stamps"))
    cells = df.groupBy("coord").agg(F.count_distinct(*STAMP).alias("_seen"))
    kept = cells.join(F.broadcast(stamps), F.lit(True)).where(
        1 - F.col("_seen") / F.col("_stamps") <= max_null_share
    )
    return df.join(kept.select("coord"), "coord", "left_semi")


def scale_int16(df: DataFrame, column: str = "speed") -> DataFrame:
    """Thousandths as smallint, truncated; null stays null."""
    return df.withColumn(column, (F.col(column) * INT_SCALE).cast("smallint"))


def coords_of(df: DataFrame) -> list[str]:
    """Sorted cell names; a thinned grid has at most a few hundred."""
    return df.agg(F.sort_array(F.collect_set("coord"))).first()[0]


def pivot_currents(df: DataFrame, variable: str, coords: Sequence[str] | None = None) -> DataFrame:
    """One row per stamp, one column ``{coord}_{variable}`` per cell.

    Naming the cells up front spares Spark the pass that would look for them.
    """
    coords = list(coords) if coords is not None else coords_of(df)
    wide = df.groupBy(*STAMP).pivot("coord", coords).agg(F.max("speed"))
    return wide.toDF(*STAMP, *[f"{c}_{variable}" for c in coords])


def join_variables(tables: Sequence[DataFrame]) -> DataFrame:
    """Stamps every variable has, with all their columns."""
    return reduce(lambda a, b: a.join(b, list(STAMP)), tables)


def aggregate_currents(tables: Mapping[str, DataFrame], box: Box) -> DataFrame:
    """Long tables per variable to one wide table of scaled integers.

    The thinned cells are stored, so listing their names costs no second pass over the
    full grid.
    """
    wide = []
    for variable, df in tables.items():
        thinned = cut(with_coord(thin_grid(currents_bbox(df, box))))
        wide.append(pivot_currents(scale_int16(drop_sparse(thinned)), variable))
    return join_variables(wide)


def floor_hours(seconds: Column, hours: int = STAMP_HOURS) -> Column:
    """Hour of the day rounded down to a multiple of ``hours``."""
    hour = hour_of(seconds)
    return hour - hour % hours


def with_stamp(df: DataFrame) -> DataFrame:
    """Add the stamp columns a message belongs to."""
    now = F.col("base_datetime")
    return df.withColumns(
        {"year": year_of(now), "month": month_of(now), "day": day_of_month(now), "hour": floor_hours(now)}
    )


def join_currents(df: DataFrame, stamps: DataFrame) -> DataFrame:
    """Each message with the currents forecast in force at its time, null where there is none.

    The range of times a forecast holds for is turned into equal keys.  The stamps' size
    depends on the years covered, so how to join is left to the planner: broadcast when
    measured small, otherwise a shuffle whose crowded stamps adaptive execution splits.
    """
    types = dict(df.dtypes)
    joined = with_stamp(df).join(stamps, list(STAMP), "left").drop("day", "hour")
    keep = {c: types.get(c, "int") for c in ("year", "month")}
    return joined.withColumns({c: F.col(c).cast(t) for c, t in keep.items()})


def water_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "water_" in c]


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def train_means(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    """Mean of each current column over the joined training rows, rounded half to even."""
    columns = list(columns) if columns is not None else water_columns(df)
    row = df.agg(*[F.bround(F.avg(_name(c)), 0).cast("smallint").alias(c) for c in columns]).first()
    return {c: value for c, value in zip(columns, row) if value is not None}


def impute(df: DataFrame, means: Mapping[str, int]) -> DataFrame:
    """Fill missing currents with the training means."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(_name(c), F.lit(v)).cast(types[c]) for c, v in means.items() if c in types}
    )


def with_imputed_flag(df: DataFrame) -> DataFrame:
    """Add ``weather_is_imputed``: some current was missing in the row."""
    missing = reduce(lambda a, b: a | b, [_name(c).isNull() for c in water_columns(df)])
    return df.withColumn("weather_is_imputed", missing)


def null_audit(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ("split",)) -> DataFrame:
    """(by..., column, nulls, percent) of every column, counted in one pass."""
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in by]
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.array(
            *[F.struct(F.lit(c).alias("column"), F.count_if(_name(c).isNull()).alias("nulls")) for c in columns]
        ).alias("_cells"),
    )
    return counts.select(*by, "_rows", F.inline("_cells")).select(
        *by, "column", "nulls", (F.col("nulls") * 100.0 / F.col("_rows")).alias("percent")
    )


def drop_join_columns(df: DataFrame) -> DataFrame:
    return df.drop("mmsi", "heading")


def append_currents(df: DataFrame, stamps: DataFrame) -> DataFrame:
    """Join, flag and fill currents for all datasets, with means learned on train."""
    joined = join_currents(drop_join_columns(df), stamps)
    means = train_means(joined.where(F.col("split") == "train"), water_columns(stamps))
    return impute(with_imputed_flag(joined), means)


def pack_currents(u: DataFrame, v: DataFrame) -> DataFrame:
    """One row per stamp with ``currents``: the cells as an array of (lat, lon, u, v).

    A cell with only one of u and v keeps it.  The array holds one entry per kept cell, a few hundred at most; it is the compact form
    feature building uses in place of hundreds of columns.
    """
    names = ["latitude", "longitude", *STAMP]
    both = u.withColumnRenamed("speed", "u").select(*names, "u").join(
        v.withColumnRenamed("speed", "v").select(*names, "v"), names, "full"
    )
    cell = F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "u", "v")
    return both.groupBy(*STAMP).agg(F.array_sort(F.collect_list(cell)).alias("currents"))


def mean_currents(df: DataFrame, packed: DataFrame) -> DataFrame:
    """One row: every cell of ``packed`` with its mean u and v over the messages of ``df``.

    Messages are counted per stamp first, so the currents are weighted and summed once per
    stamp instead of once per message.
    """
    weights = with_stamp(df).groupBy(*STAMP).agg(F.count(F.lit(1)).alias("_n"))
    cells = packed.select(*STAMP, F.inline("currents")).join(weights, list(STAMP), "left")

    def mean(name):
        total = F.sum(F.when(F.col(name).isNotNull(), F.col("_n")))
        return F.bround(F.try_divide(F.sum(F.col(name) * F.col("_n")), total), 0).cast("smallint").alias(name)

    means = cells.groupBy("lat", "lon").agg(mean("u"), mean("v"))
    return means.agg(F.array_sort(F.collect_list(F.struct("lat", "lon", "u", "v"))).alias("frame"))


def fill_packed(packed: DataFrame, frame: DataFrame) -> DataFrame:
    """Every stamp with every cell of the frame, missing values taken from the frame's means.

    Adds ``partial``: the stamp lacked some cell.
    """
    names = ["lat", "lon"]
    seen = packed.select(*STAMP, F.inline("currents")).withColumnRenamed("u", "_u").withColumnRenamed("v", "_v")
    every = packed.select(*STAMP).join(F.broadcast(frame), F.lit(True)).select(*STAMP, F.inline("frame"))
    cells = every.join(seen, [*STAMP, *names], "left")
    cell = F.struct("lat", "lon", F.coalesce("_u", "u").alias("u"), F.coalesce("_v", "v").alias("v"))
    missing = F.col("_u").isNull() | F.col("_v").isNull()
    return cells.groupBy(*STAMP).agg(
        F.array_sort(F.collect_list(cell)).alias("currents"), F.bool_or(missing).alias("partial")
    )


def append_packed(
    df: DataFrame, packed: DataFrame, describe: Callable[[DataFrame], DataFrame] = lambda stamps: stamps, train: DataFrame | None = None
) -> DataFrame:
    """Join packed currents to messages and fill what is missing with the training means.

    ``describe`` adds columns computed from ``currents`` alone.  It runs on the stamps, of
    which there are few, and the messages receive its results by the join; messages without
    a stamp receive those of the mean frame, a single broadcast row.  ``train`` are the messages
    that weigh the means, those of ``df`` in the training split if left out.
    """
    frame = mean_currents(df.where(F.col("split") == "train") if train is None else train, packed)
    stamps = describe(fill_packed(packed, frame))
    fallback = describe(frame.withColumnRenamed("frame", "currents"))
    added = fallback.columns
    types = dict(df.dtypes)
    joined = with_stamp(df).join(stamps, list(STAMP), "left")
    both = joined.join(F.broadcast(fallback.toDF(*[f"_mean_{c}" for c in added])), F.lit(True))
    keep = {c: F.col(c).cast(types[c]) for c in ("year", "month") if c in types}
    filled = {c: F.when(F.col("partial").isNull(), F.col(f"_mean_{c}")).otherwise(F.col(c)) for c in added}
    return both.withColumns(
        {**keep, **filled, "weather_is_imputed": F.coalesce("partial", F.lit(True))}
    ).drop("day", "hour", "partial", *[f"_mean_{c}" for c in added])
