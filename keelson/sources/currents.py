"""Bringing gridded ocean currents in: reshaping, model regions, index ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.clock import day_of_month, hour_of, month_of, year_of

# Model regions in lookup order (region, lat min, lat max, lon min, lon max).
# Region 6 is published with its longitudes reversed and so contains no box.
MODEL_REGIONS = [
    (1, 0.0, 70.0, -99.99996948242188, -50.0),
    (6, 10.0, 70.0, -150.00001525878906, -210.0),
    (7, 10.0, 60.0, -149.99996948242188, -100.0),
    (17, 60.0, 80.0, -179.99996948242188, -120.0),
]


def currents_to_long(df: DataFrame, longitudes: list[str]) -> DataFrame:
    """Rows of (time, latitude, one column per longitude) become one row per cell.

    Longitudes given as 180..360 degrees throughout are moved to -180..0.
    """
    shift = -360.0 if all(float(name) > 180 for name in longitudes) else 0.0
    columns = [F.col(f"`{name}`") for name in longitudes]
    cells = df.unpivot(["time", "latitude"], columns, "longitude", "speed")
    seconds = F.col("time")
    return cells.select(
        "latitude",
        F.round(F.col("longitude").cast("double") + shift, 6).alias("longitude"),
        "speed",
        year_of(seconds).alias("year"),
        month_of(seconds).alias("month"),
        day_of_month(seconds).alias("day"),
        hour_of(seconds).alias("hour"),
    )


def region_for_box(boxes: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``region``: the first model region that contains (lat_1..lat_2, lon_1..lon_2).

    A box no region contains raises, or gets null when ``strict`` is off.
    """
    region = F.lit(None).cast("int")
    for number, lat_min, lat_max, lon_min, lon_max in reversed(MODEL_REGIONS):
        inside = (
            (F.col("lat_1") >= lat_min)
            & (F.col("lat_2") <= lat_max)
            & (F.col("lon_1") >= lon_min)
            & (F.col("lon_2") <= lon_max)
        )
        region = F.when(inside, F.lit(number)).otherwise(region)
    if strict:
        region = F.coalesce(region, F.raise_error(F.lit("no model region covers the box")).cast("int"))
    return boxes.withColumn("region", region)


def margin_slice(axis: DataFrame, low: float, high: float, margin: float = 1.0, modulo: float | None = None):
    """Index range (min_index, max_index, n_values) of the axis values in [low-margin, high+margin].

    ``axis(axis_index, value)`` lists one grid axis.  Raises when nothing is in range or
    when the picked indexes are not evenly spaced.
    """
    low, high = low - margin, high + margin
    if modulo is not None:
        low, high = low % modulo, high % modulo
    picked = axis.where(F.col("value").between(low, high))
    facts = picked.agg(
        F.min("axis_index").alias("min_index"),
        F.max("axis_index").alias("max_index"),
        F.count(F.lit(1)).alias("n_values"),
        F.sort_array(F.collect_list("axis_index")).alias("_all"),
    )
    steps = F.zip_with(
        F.slice("_all", 2, F.greatest(F.size("_all") - 1, F.lit(0))),
        F.slice("_all", 1, F.greatest(F.size("_all") - 1, F.lit(0))),
        lambda later, earlier: later - earlier,
    )
    uneven = (F.col("n_values") > 1) & (F.size(F.array_distinct(steps)) != 1)
    checked = (
        F.when(F.col("n_values") == 0, F.raise_error(F.lit("no grid value in range")).cast("bigint"))
        .when(uneven, F.raise_error(F.lit("the picked indexes are not evenly spaced")).cast("bigint"))
        .otherwise(F.col("n_values"))
    )
    return facts.select(
        F.col("min_index").cast("bigint").alias("min_index"),
        F.col("max_index").cast("bigint").alias("max_index"),
        checked.alias("n_values"),
    )
