"""Centroid clustering of integer vectors, with centroids ruled out by n-simplex projection.

A few vectors serve as pivots.  They span a base simplex, and the distances of a vector to them, measured once and
stored, fix an apex over that base: its coordinates in as many dimensions as there are pivots.  For two apexes a, b
the plain distance of a and b is a lower bound of the distance of the vectors, and the distance of a to b mirrored at
the base an upper one.  A centroid whose lower bound passes another centroid's upper bound cannot be the nearest;
those that are left are compared by exact integers, so that the bounds never decide a result.

Vectors count when they have exactly ``size`` components, all finite, also after scaling; others are no part of the
result.  A component x becomes floor(scale * x).  Centroids start as the vectors of the smallest hash of their id
(equal hashes: the lesser vector first); every round assigns (ties: the smaller number) and replaces each non-empty
centroid by the exact floor of its mean.  Fewer vectors than centroids give fewer centroids; an empty table gives an
empty result; repeated rows are vectors of their own; a null id is hashed as ``null``.  Distances beyond a long are
null, as are sums of them; the clusters are right all the same.  Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.storage import cut

#: Components up to this size leave squared distances of 64 components within 64-bit integers.
NARROW = 1 << 26
LONG = 2**63 - 1
#: Vectors handled at once in a task.
_ROWS = 4096
#: Bits to a limb of a component's sum, which has no bound of its own.
_LIMB = 56


class Simplex:
    """The base simplex of a few pivots; turns distances to them into apex coordinates and bounds."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots = pivots[:1]
        self.base = np.zeros((0, 0))
        self.least = 1.0
        for pivot in pivots[1:]:
            apex = self.apexes(pivot[None, :])[0, :-1]
            far = np.sqrt(((self.pivots - pivot) ** 2).sum(1)).max()
            if not apex[-1] > 1e-3 * far:  # as good as within the span of those before it
                continue
            grown = np.zeros((len(self.pivots), len(self.pivots)))
            grown[:-1, :-1] = self.base
            grown[-1] = apex
            self.base, self.pivots = grown, np.vstack([self.pivots, pivot])
            self.least = float(np.diag(grown).min())

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates over the base, then the height, then a bound of what rounding can have moved them by."""
        squares = np.stack([((vectors - p) ** 2).sum(1) for p in self.pivots], axis=1)
        right = (squares[:, :1] - squares[:, 1:] + (self.base**2).sum(1)) / 2
        flat = np.linalg.solve(self.base, right.T).T if len(self.base) else right
        height = np.sqrt(np.maximum(squares[:, 0] - (flat**2).sum(1), 0))
        most = squares.max(1)
        return np.column_stack([flat, height, 1e-10 * most / self.least + 1e-6 * np.sqrt(most)])


def left_open(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids may be nearest, by the bounds from both sides' apexes; what cannot be told stays."""
    a, c = apexes[:, None, :], centroids[None, :, :]
    flat = ((a[..., :-2] - c[..., :-2]) ** 2).sum(-1)
    slack = a[..., -1] + c[..., -1]
    lower = np.sqrt(flat + (a[..., -2] - c[..., -2]) ** 2) - slack
    upper = np.sqrt(flat + (a[..., -2] + c[..., -2]) ** 2) + slack
    return ~(lower > upper.min(1)[:, None])


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: list[list[int]], simplex: Simplex) -> tuple[np.ndarray, np.ndarray]:
    """The number of each vector's nearest centroid and the exact squared distance to it."""
    with np.errstate(all="ignore"):
        open_ = left_open(apexes, simplex.apexes(np.array(centroids, float)))
    narrow = np.abs(vectors).max(initial=0) <= NARROW and all(abs(x) <= NARROW for c in centroids for x in c)
    exact = vectors.astype(np.int64) if narrow else as_integers(vectors)
    cents = np.array(centroids, np.int64 if narrow else object)
    row, number = np.nonzero(open_)
    gaps = exact[row] - cents[number]
    squares = (gaps * gaps).sum(1)
    table = np.full(open_.shape, squares.max(initial=0) + 1, exact.dtype)
    table[row, number] = squares
    best = table.argmin(1)
    return best, table[np.arange(len(best)), best]


def as_integers(vectors: np.ndarray) -> np.ndarray:
    """Whole doubles of any size as Python integers."""
    return np.array([int(x) for x in vectors.ravel().tolist()], object).reshape(vectors.shape)


def limbs(sums: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """Integers of any size as short ones, lowest first: the sum of limb i times 2 ** (i * _LIMB)."""
    half, rest, i = 1 << (_LIMB - 1), sums, 0
    while i == 0 or any(rest):
        low = [((int(x) + half) & ((1 << _LIMB) - 1)) - half for x in rest]
        yield i, low
        rest = [(int(x) - y) >> _LIMB for x, y in zip(rest, low)]
        i += 1


def floats(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


@dataclass
class Clusters:
    """``rows``: vec_id, cluster, distance of every vector that counts; ``centroids``: their integer components by number."""

    rows: DataFrame
    centroids: list[list[int]]


def usable(components: Column, size: int, scale: int) -> Column:
    """Whether a vector counts."""
    finite = F.forall(components, lambda x: x.isNotNull() & (F.abs(x * F.lit(float(scale))) < F.lit(float("inf"))))
    return F.coalesce((F.size(components) == size) & finite, F.lit(False))


def fit(
    vectors: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3, pivots: int = 6, id_col: str = "vec_id", vec_col: str = "embedding"
) -> Clusters:
    """Cluster; the driver holds the pivots, the centroids and their sums: k times ``size`` numbers, however many vectors."""
    spark = vectors.sparkSession
    kept = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("x")).where(usable(F.col("x"), size, scale))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = [np.floor(np.array(r["x"]) * scale) for r in kept.orderBy(digest, "x").limit(k + pivots).collect()]
    if not first:
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [])
    simplex = Simplex(np.array(first[k:] or first[:1]))
    centroids = as_integers(np.array(first[:k])).tolist()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            whole = np.floor(floats(batch.column("x"), size) * scale)
            with np.errstate(all="ignore"):
                apexes = simplex.apexes(whole)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel())) for m in (whole, apexes)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *lists], names=["vec_id", "whole", "apex"])

    stored = cut(kept.mapInArrow(project, "vec_id long, whole array<double>, apex array<double>"))
    width = len(simplex.pivots) + 1

    def sums(centroids: list[list[int]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((len(centroids), size), object), np.zeros(len(centroids), np.int64)
            for batch in _sliced(batches):
                whole = floats(batch.column("whole"), size)
                best, _ = nearest(whole, floats(batch.column("apex"), width), centroids, simplex)
                exact = whole.astype(np.int64) if np.abs(whole).max(initial=0) <= NARROW else as_integers(whole)
                for c in np.unique(best).tolist():
                    total[c] += exact[best == c].sum(0)
                    count[c] += int((best == c).sum())
            rows = [(c, i, int(count[c]) if i == 0 else 0, low) for c in np.flatnonzero(count).tolist() for i, low in limbs(total[c])]
            if rows:
                c, i, n, low = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(i, pa.int32()), pa.array(n, pa.int64()), pa.array(low, pa.list_(pa.int64()))], names=["cluster", "limb", "n", "low"])

        return run

    for _ in range(rounds):
        parts = stored.select("whole", "apex").mapInArrow(sums(centroids), "cluster int, limb int, n long, low array<long>")
        at = parts.select("cluster", "limb", "n", F.posexplode("low").alias("at", "low")).groupBy("cluster", "limb", "at")
        total: dict[int, list[int]] = {}
        count: dict[int, int] = {}
        for r in at.agg(F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.sum("n").alias("n")).collect():
            total.setdefault(r["cluster"], [0] * size)[r["at"]] += int(r["low"]) << (_LIMB * r["limb"])
            count[r["cluster"]] = max(count.get(r["cluster"], 0), r["n"])
        for c, components in total.items():
            centroids[c] = [x // count[c] for x in components]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            best, squares = nearest(floats(batch.column("whole"), size), floats(batch.column("apex"), width), centroids, simplex)
            far = pa.array([int(s) if s <= LONG else None for s in squares.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(best, pa.int32()), far], names=["vec_id", "cluster", "distance"])

    return Clusters(cut(stored.mapInArrow(assign, "vec_id long, cluster int, distance long")), centroids)


def describe(clusters: Clusters) -> DataFrame:
    """One row per centroid: cluster, size, cluster_inertia, inertia, centroid (components), centroid_sha256."""
    spark = clusters.rows.sparkSession
    far = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("far")
    found = {r["cluster"]: (r["size"], r["far"]) for r in clusters.rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), far).collect()}  # a row per centroid

    def long_or_null(x):
        return None if x is None or x > LONG else int(x)

    every = [far for _, far in found.values()]
    inertia = long_or_null(None if None in every else sum(every))
    rows = []
    for c, components in enumerate(clusters.centroids):
        text = [str(x) for x in components]
        size, far_c = found.get(c, (0, 0))
        rows.append((c, size, long_or_null(far_c), inertia, text, hashlib.sha256(",".join(text).encode()).hexdigest()))
    return spark.createDataFrame(rows, "cluster int, size long, cluster_inertia long, inertia long, centroid array<string>, centroid_sha256 string")


def with_totals(clusters: Clusters) -> DataFrame:
    """The rows with cluster_inertia, inertia and centroid_sha256 beside them; the table joined has a row per centroid."""
    totals = describe(clusters).select("cluster", "cluster_inertia", "inertia", "centroid_sha256")
    return clusters.rows.join(F.broadcast(totals), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def twin_sql(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The same clustering in SQL, round by round."""
    head = f"""
with kept as (
  select row_number() over () as rid, vec_id, [cast(floor({scale} * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings where len(embedding) = {size} and len([x for x in embedding if isfinite(x)]) = {size}
), cells as materialized (
  select rid, unnest(v) as x, unnest(range({size})) as dim from kept
), seeds as (
  select row_number() over (order by sha256('{seed}:' || coalesce(cast(vec_id as varchar), 'null')), v) - 1 as c, v from kept
  qualify c < {k}
), c0 as materialized (
  select c, unnest(v) as y, unnest(range({size})) as dim from seeds
)"""
    each = """, a{i} as materialized (
  select rid, c, d from (
    select rid, c, cast(sum((x - y) * (x - y)) as bigint) as d from cells join c{i} using (dim) group by rid, c)
  qualify row_number() over (partition by rid order by d, c) = 1
)"""
    mean = """, s{i} as (
  select c, dim, cast(sum(x) as bigint) as s, count(*) as n from a{i} join cells using (rid) group by c, dim
), c{j} as materialized (
  select c, dim, coalesce((s - ((s % n) + n) % n) // n, y) as y from c{i} left join s{i} using (c, dim)
)"""
    tail = """
, named as (
  select c, sha256(string_agg(cast(y as varchar), ',' order by dim)) as centroid_sha256 from c{i} group by c
)
select vec_id, cast(c as integer) as cluster, d as distance, cast(sum(d) over (partition by c) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia, centroid_sha256
from a{i} join kept using (rid) join named using (c)
"""
    return head + "".join(each.format(i=i) + mean.format(i=i, j=i + 1) for i in range(rounds)) + each.format(i=rounds) + tail.format(i=rounds)
