"""A grid over the globe for joins within a radius.

Two points of one cell are never farther apart than the radius, and points within the
radius of a cell lie in a bounded ring of cells around it.  Radius joins thus become equal
joins on cell, with an exact distance check.  ``eps_km`` is a column, so several radii can
share one job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.geo import CLUSTER_RADIUS_KM

CELL = ("band", "col")
# Side / radius; just below 1/sqrt(2), so that the diagonal stays within the radius.
_SIDE = 0.7071
CROWDED = 20_000
SALTS = 64


def _band_height() -> Column:
    return F.degrees(F.col("eps_km") * _SIDE / CLUSTER_RADIUS_KM)


def _near_equator(band: Column) -> Column:
    """Cosine at the edge of the band nearest the equator: where it is widest."""
    height = _band_height()
    edge = F.greatest(F.lit(0.0), band * height, -(band + 1) * height)
    return F.cos(F.radians(F.least(edge, F.lit(90.0))))


def _columns(band: Column) -> Column:
    """Cells around the globe in a band."""
    around = 2 * 3.141592653589793 * CLUSTER_RADIUS_KM * _near_equator(band)
    return F.greatest(F.lit(1), F.ceil(around / (F.col("eps_km") * _SIDE)).cast("bigint"))


def with_cell(df: DataFrame) -> DataFrame:
    """Add ``band`` and ``col`` for lat/lon under the row's ``eps_km``."""
    banded = df.withColumn("band", F.floor(F.col("lat") / _band_height()).cast("bigint"))
    n = _columns(F.col("band"))
    return banded.withColumn("col", F.pmod(F.floor((F.col("lon") + 180.0) / 360.0 * n).cast("bigint"), n))


def with_ring(df: DataFrame) -> DataFrame:
    """One row per cell that may hold a point within ``eps_km`` of the row's cell (own cell included).

    Adds ``ring_band`` and ``ring_col``; the ring wraps at the date line.
    """
    height = _band_height()
    n = _columns(F.col("band"))
    low = F.col("col") / n * 360.0
    high = (F.col("col") + 1) / n * 360.0
    spread = df.withColumn("ring_band", F.explode(F.array(*[F.col("band") + i for i in range(-2, 3)])))
    # Widest longitude difference two points within the radius can have in these two bands.
    far = F.greatest(
        F.abs(F.col("band") * height), F.abs((F.col("band") + 1) * height),
        F.abs(F.col("ring_band") * height), F.abs((F.col("ring_band") + 1) * height),
    )
    narrow = F.cos(F.radians(F.least(far, F.lit(90.0))))
    ratio = F.when(narrow > 1e-9, F.sin(F.col("eps_km") / (2 * CLUSTER_RADIUS_KM)) / narrow).otherwise(F.lit(1.0))
    reach = F.degrees(2 * F.asin(F.least(F.lit(1.0), ratio))) + 1e-9
    m = _columns(F.col("ring_band"))
    first = F.floor((low - reach) / 360.0 * m).cast("bigint")
    last = F.least(F.floor((high + reach) / 360.0 * m).cast("bigint"), first + m - 1)
    return spread.withColumn("_m", m).withColumn("_at", F.explode(F.sequence(first, last))).withColumn(
        "ring_col", F.pmod("_at", "_m")
    ).drop("_at", "_m")


def radius_candidates(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = (), spread: bool = False,
    dealt: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Join each left row to the right rows of the cells around it; columns get l_/r_ prefixes.

    ``left`` and ``right`` carry ``keys``, ``eps_km`` and cells.  Right cells with more than
    ``CROWDED`` rows (at most rows/CROWDED of them, hence the broadcast) are cut into salted
    parts, each met by its own copy of the left rows, so no task receives a whole crowd.

    ``spread`` deals the cells out over all shuffle partitions: where few bytes make many pairs, the join must not follow
    the few tasks that the bytes would get.  ``dealt`` then adds columns to both sides, past the exchange.
    """
    cell = [*keys, *CELL]
    crowded = (
        right.groupBy(*cell).count().where(F.col("count") > CROWDED).select(*cell, F.lit(SALTS).alias("_parts"))
    )
    spot_hash = F.pmod(F.xxhash64("lat", "lon"), F.coalesce("_parts", F.lit(1)))
    r = right.join(F.broadcast(crowded), cell, "left").withColumn("_salt", spot_hash.cast("int")).drop("_parts")
    ring = with_ring(left)
    at_ring = crowded.withColumnsRenamed({"band": "ring_band", "col": "ring_col"})
    ring = ring.join(F.broadcast(at_ring), [*keys, "ring_band", "ring_col"], "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    ).drop("_parts")
    if spread:
        parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ring = ring.repartition(parts, "ring_band", "ring_col", "_salt", *keys)
        r = r.repartition(parts, *CELL, "_salt", *keys)
    if dealt:
        ring, r = dealt(ring), dealt(r)
    l_named = ring.select(*[F.col(c).alias(c if c in keys else f"l_{c}") for c in ring.columns])
    r_named = r.select(*[F.col(c).alias(c if c in keys else f"r_{c}") for c in r.columns])
    on = [l_named["l_ring_band"] == r_named["r_band"], l_named["l_ring_col"] == r_named["r_col"], l_named["l__salt"] == r_named["r__salt"]]
    for k in keys:
        on.append(l_named[k] == r_named[k])
    joined = l_named.join(r_named, on)
    for k in keys:
        joined = joined.drop(r_named[k])
    return joined.drop("l_ring_band", "l_ring_col", "l__salt", "r__salt")
