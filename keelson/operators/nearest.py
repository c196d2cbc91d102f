"""The current cells nearest to a position, through an index over small tiles.

All points of a tile lie within its radius r of its centre, so a cell among the k nearest of any of them is at most
2r farther from the centre than the centre's own k-th nearest cell.  The index holds those few candidates for every
tile that has a position; a message then measures its distance to the candidates of its tile only, and orders whole
numbers instead of rows.  Tiles and cells are bounded by the study area, not by the number of messages.

Distances are compared in millimetres, so that cells equally far but for rounding order by position.  A message
without a position has no nearest cells: null statistics and arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.geo import great_circle_km, haversine
from keelson.operators.features import NEAREST_ARRAY, NEAREST_COUNTS, magnitude

#: Edge of a tile in degrees.
TILE = 0.05
#: What rounding may add to a distance, in km.
_SLACK_KM = 1e-5


def grid_of(stamps: DataFrame) -> DataFrame:
    """One row: ``grid``, the positions of all current cells of ``stamps``, in the order of filled currents."""
    cells = stamps.select(F.inline("currents")).select("lat", "lon").distinct()
    return cells.agg(F.sort_array(F.collect_list(F.struct("lat", "lon"))).alias("grid"))


def _tile(degrees) -> Column:
    return F.floor(degrees / TILE).cast("int")


def near_index(positions: DataFrame, grid: DataFrame, k: int = max(NEAREST_COUNTS)) -> DataFrame:
    """(tile_lat, tile_lon, candidates) for every tile of ``positions``; a candidate is (far, slot, lat, lon)."""
    tiles = positions.select(_tile(F.col("lat")).alias("tile_lat"), _tile(F.col("lon")).alias("tile_lon")).where("tile_lat is not null and tile_lon is not null").distinct()
    south, west = F.col("tile_lat") * TILE, F.col("tile_lon") * TILE
    lat, lon = south + TILE / 2, west + TILE / 2
    radius = F.greatest(haversine(lat, lon, south, west), haversine(lat, lon, south + TILE, west)) + _SLACK_KM
    every = tiles.join(F.broadcast(grid), F.lit(True)).select("tile_lat", "tile_lon", F.posexplode("grid").alias("slot", "cell"))
    cell = F.struct(haversine(lat, lon, F.col("cell.lat"), F.col("cell.lon")).alias("far"), "slot", "cell.lat", "cell.lon")
    near = every.groupBy("tile_lat", "tile_lon").agg(F.sort_array(F.collect_list(cell)).alias("cells"))  # one grid to a group
    limit = F.element_at("cells", F.least(F.lit(k), F.size("cells")))["far"] + 2 * radius
    within = near.withColumn("_limit", limit)
    return within.select("tile_lat", "tile_lon", F.filter("cells", lambda c: c["far"] <= F.col("_limit")).alias("candidates"))


def _ordered(lat: pa.Array, lon: pa.Array, candidates: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, places (from 0, below ``k``) and candidates by number, in order of row and distance."""
    lists = candidates.fill_null([])
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    cells = lists.flatten()
    here = (x.to_numpy(zero_copy_only=False)[row] for x in (lat, lon))
    to_lat, to_lon, slot = (cells.field(n).to_numpy(zero_copy_only=False) for n in ("lat", "lon", "slot"))
    millimetres = np.floor(great_circle_km(*here, to_lat, to_lon) * 1e6 + 0.5)
    order = np.lexsort((slot, millimetres, row))
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return row[place < k], place[place < k], order[place < k]


def _candidates(df: DataFrame, index: DataFrame) -> DataFrame:
    keyed = df.withColumns({"tile_lat": _tile(F.col("lat")), "tile_lon": _tile(F.col("lon"))})
    return keyed.join(index, ["tile_lat", "tile_lon"], "left").drop("tile_lat", "tile_lon")


def with_nearest(df: DataFrame, index: DataFrame, k: int = max(NEAREST_COUNTS), name: str = "near") -> DataFrame:
    """Add ``name``: the slots in the grid of the row's ``k`` nearest cells, nearest first; null without a position."""

    @F.arrow_udf("array<int>")
    def slots(lat: pa.Array, lon: pa.Array, candidates: pa.Array) -> pa.Array:
        row, _, cell = _ordered(lat, lon, candidates, k)
        ends = np.searchsorted(row, np.arange(len(lat) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), candidates.fill_null([]).flatten().field("slot").take(pa.array(cell)).cast(pa.int32()))

    found = _candidates(df, index).withColumn(name, slots("lat", "lon", "candidates"))
    return found.withColumn(name, F.when(F.col("candidates").isNotNull(), F.col(name))).drop("candidates")


def nearest_stats(df: DataFrame, index: DataFrame, counts: Sequence[int] = NEAREST_COUNTS) -> DataFrame:
    """Mean and sample deviation of the current speed over the n nearest cells (no deviation for one).

    ``currents`` are filled currents, with the cells of the index's grid in its order; ``speeds``, if there, their
    speeds.  A cell without a speed is left out of the n; where none or, for deviations, one is left, the result is null.
    """
    rows = df if "speeds" in df.columns else df.withColumn("speeds", F.transform("currents", magnitude))
    names = [f"{n}_closest_weather_magnitude_{kind}" for n in counts for kind in ("mean", "std") if (n, kind) != (1, "std")]
    k = max(counts)

    @F.arrow_udf(f"struct<{', '.join(f'`{n}`: double' for n in names)}>")
    def stats(lat: pa.Array, lon: pa.Array, candidates: pa.Array, speeds: pa.Array) -> pa.Array:
        row, place, cell = _ordered(lat, lon, candidates, k)
        slot = candidates.fill_null([]).flatten().field("slot").to_numpy(zero_copy_only=False)[cell]
        speeds = speeds.fill_null([])
        first = np.cumsum(speeds.value_lengths().to_numpy(zero_copy_only=False)) - speeds.value_lengths().to_numpy(zero_copy_only=False)
        near = np.full((len(lat), k), np.nan)
        near[row, place] = speeds.flatten().to_numpy(zero_copy_only=False)[first[row] + slot]
        out = []
        for n in counts:
            some = near[:, :n]
            there = ~np.isnan(some)
            many = there.sum(1)
            mean = np.where(there, some, 0).sum(1) / np.maximum(many, 1)
            out.append(pa.array(mean, mask=many == 0))
            if n > 1:
                gaps = np.where(there, some - mean[:, None], 0)
                out.append(pa.array(np.sqrt((gaps * gaps).sum(1) / np.maximum(many - 1, 1)), mask=many < 2))
        return pa.StructArray.from_arrays(out, names=names)

    found = _candidates(rows, index).withColumn("_stats", stats("lat", "lon", "candidates", "speeds"))
    return found.withColumns({n: F.col("_stats")[n] for n in names}).drop("_stats", "candidates", *([] if "speeds" in df.columns else ["speeds"]))


def nearest_arrays(df: DataFrame, index: DataFrame, k: int = NEAREST_ARRAY) -> DataFrame:
    """Arrays of u, v, latitude and longitude of the k nearest cells, by distance."""
    near = with_nearest(df, index, k, "_near").withColumn("_near", F.transform("_near", lambda s: F.element_at("currents", s + 1)))
    names = {"us": "u", "vs": "v", "lats": "lat", "lons": "lon"}
    return near.withColumns({f"closest_weather_{n}": F.col("_near")[f] for n, f in names.items()}).drop("_near")
