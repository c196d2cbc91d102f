"""Features of whole windows, from windows that are rows with an array per column (``windows.windows_of``).

Every feature is an expression on the row, so nothing here shuffles or copies a row of a track into its windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.geo import bearing, haversine
from keelson.operators.features import mean_of, std_pop_of
from keelson.operators.windows import at_steps

WINDOW = ("dataset", "track", "window_id")


def select_steps(df: DataFrame, steps: Sequence[int]) -> DataFrame:
    """The windows with their arrays cut down to some steps."""
    columns = [c for c in df.columns if c not in WINDOW]
    return df.withColumns({c: at_steps(F.col(c), steps) for c in columns})


def with_window_stats(df: DataFrame, columns: Sequence[str] = ("sog", "cog"), which: str = "min_median_max", steps: Sequence[int] | None = None) -> DataFrame:
    """Add ``{column}_min``, ``_median`` and ``_max`` over the values that are there, at all or some steps; null when none is."""
    low, high = F.get("_sorted", F.floor((F.size("_sorted") - 1) / 2).cast("int")), F.get("_sorted", F.floor(F.size("_sorted") / 2).cast("int"))
    out = df
    for c in columns:
        values = F.col(c) if steps is None else at_steps(F.col(c), steps)
        if which == "min_median_max":
            out = out.withColumns({f"{c}_min": F.array_min(values), f"{c}_max": F.array_max(values)})
        out = out.withColumn("_sorted", F.sort_array(F.array_compact(values.cast("array<double>")))).withColumn(f"{c}_median", (low + high) / 2).drop("_sorted")
    return out


def travelled(lat: Column, lon: Column) -> Column:
    """km from the first to the last step."""
    return haversine(F.element_at(lat, 1), F.element_at(lon, 1), F.element_at(lat, -1), F.element_at(lon, -1))


def with_window_distance(df: DataFrame) -> DataFrame:
    return df.withColumn("distance_traveled", travelled(F.col("lat"), F.col("lon")))


def with_window_bearings(df: DataFrame) -> DataFrame:
    """Add the mean and population deviation of the bearings between consecutive steps."""
    points = F.arrays_zip("lat", "lon")
    hops = F.zip_with(F.slice(points, F.lit(1), F.size("lat") - 1), F.slice(points, F.lit(2), F.size("lat") - 1), lambda a, b: bearing(a["lat"], a["lon"], b["lat"], b["lon"]))
    return df.withColumn("_hops", hops).withColumns({"mean_bearing_angle": mean_of(F.col("_hops")), "std_bearing_angle": std_pop_of(F.col("_hops"))}).drop("_hops")


def last_steps(df: DataFrame, path: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """The last step's value of every array, and the whole path as arrays ``lats`` and ``lons``."""
    arrays = [name for name, kind in df.dtypes if kind.startswith("array<") and name not in WINDOW]
    paths = [F.col(c).alias(f"{c}s") for c in path]
    return df.select(*[F.element_at(c, -1).alias(c) if c in arrays else F.col(c) for c in df.columns], *paths)


def step_rows(df: DataFrame, steps: Sequence[int]) -> DataFrame:
    """One row per window and step: ``step``, each array's value there, and the window's other columns."""
    arrays = [name for name, kind in df.dtypes if kind.startswith("array<") and name not in WINDOW]
    others = [F.col(c) for c in df.columns if c not in arrays]
    zipped = F.arrays_zip(F.array(*[F.lit(int(s)) for s in steps]).alias("step"), *[F.col(a) for a in arrays])
    return df.select(*others, F.inline(zipped))
