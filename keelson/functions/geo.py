"""Great-circle geometry as Column expressions (no UDFs, so scans stay inside codegen), and for arrays in a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# The mean earth radius and the nautical mile used for reported distances,
# and the rounder radius used by the clustering and the loss.
EARTH_RADIUS_KM = 6371.0088
NM_PER_KM = 0.539956803
CLUSTER_RADIUS_KM = 6371.0
MAX_UTM_ZONE = 19


def haversine(lat1, lon1, lat2, lon2, unit: str = "km", radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance between two points in degrees, null without one of them; ``unit`` is 'km' or 'nm'."""
    a, b = F.radians(lat1), F.radians(lat2)
    dlat = (b - a) / 2
    dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(a) * F.cos(b) * F.sin(dlon) * F.sin(dlon)
    # least and greatest would pass over a null and make a missing position 0 km away
    km = F.lit(2 * radius) * F.asin(F.sqrt(F.when(h > 1.0, F.lit(1.0)).when(h < 0.0, F.lit(0.0)).otherwise(h)))
    if unit == "km":
        return km
    if unit == "nm":
        return km * F.lit(NM_PER_KM)
    raise ValueError(f"unknown unit {unit!r}")


def great_circle_km(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> np.ndarray:
    """:func:`haversine` for arrays inside a task."""
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin((np.radians(lon2) - np.radians(lon1)) / 2) ** 2
    return 2 * radius * np.arcsin(np.sqrt(np.clip(h, 0, 1)))


def bearing(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing from the first point to the second, in [0, 360)."""
    a, b = F.radians(lat1), F.radians(lat2)
    dlon = F.radians(lon2 - lon1)
    east = F.cos(b) * F.sin(dlon)
    north = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(dlon)
    turned = F.degrees(F.atan2(east, north))
    return F.when(turned < 0, turned + 360.0).otherwise(turned)


def utm_zone(lat, lon) -> Column:
    """UTM zone number of a longitude; the cut-outs around Norway lie above zone 19.

    Zones above 19 are outside the source's coverage and raise.
    """
    zone = (F.floor((lon + 180.0) / 6.0) + 1).cast("bigint")
    message = F.concat(F.lit("position outside the covered zones: zone "), zone.cast("string"))
    return F.when(zone <= MAX_UTM_ZONE, zone).otherwise(F.raise_error(message).cast("bigint"))
