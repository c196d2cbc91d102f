"""A classifier from final positions to clusters: one small random forest per coarse position cell.

Clusters are local, so a position is classified by the forest of its cell alone.  Forests are fitted in grouped
tasks, each on its cell's labelled rows, and stay a table: neither the number of clusters nor that of cells meets a
limit or the driver.  A cell whose rows all have one cluster needs no forest.  Every tree draws its rows with
replacement (Poisson counts at the subsample rate); the trees that did not draw a row vote on it, which gives the
share of rows right out of bag without a second fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.ordered import shuffled_rank
from keelson.functions.storage import cut

NOISE = -1
CELL = ("cell_lat", "cell_lon")
_TREES = "feature array<int>, threshold array<double>, below array<int>, above array<int>, label array<bigint>, roots array<int>"
_FOREST = f"cell_lat int, cell_lon int, rows bigint, oob_rows bigint, oob_correct bigint, {_TREES}"
#: Positions to a group of a crowded cell when they are classified.
_PART_ROWS = 50_000


def best_split(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """The least Gini impurity (as a negated score) of a cut of ``x``, and the cut; infinite if all values agree.

    Squared class weights left and right of every cut follow from running sums by class, for any number of classes.
    """
    order = np.argsort(x, kind="stable")
    x, y, w = x[order], y[order], w[order]
    by_class = np.argsort(y, kind="stable")
    running = np.cumsum(w[by_class])
    first = np.searchsorted(y[by_class], np.arange(y.max() + 2))
    starts = np.concatenate([[0.0], running])[first]
    before = np.empty(len(x))
    before[by_class] = running - w[by_class] - starts[:-1][y[by_class]]
    total = np.diff(starts)
    left = np.cumsum(2 * before * w + w * w)
    right = (total**2).sum() - np.cumsum(2 * (total[y] - before) * w - w * w)
    weight = np.cumsum(w)
    cuts = np.flatnonzero(x[1:] > x[:-1])
    if not len(cuts):
        return np.inf, 0.0
    score = -(left[cuts] / weight[cuts] + right[cuts] / (weight[-1] - weight[cuts]))
    at = cuts[score.argmin()]
    return float(score.min()), float(x[at] + (x[at + 1] - x[at]) / 2)


def grow(points: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int) -> dict[str, list]:
    """A tree on weighted points: per node the feature (-1 at a leaf), threshold, children and majority class."""
    tree: dict[str, list] = {k: [] for k in ("feature", "threshold", "below", "above", "label")}

    def node(label: int) -> int:
        for k, v in zip(tree, (-1, 0.0, -1, -1, label)):
            tree[k].append(v)
        return len(tree["label"]) - 1

    some = np.flatnonzero(w > 0)
    weights = np.bincount(y[some], w[some])
    todo = [(node(int(weights.argmax())), some, depth)]
    while todo:
        at, rows, left = todo.pop()
        classes = np.bincount(y[rows], w[rows])
        if left == 0 or (classes > 0).sum() < 2:
            continue
        splits = [best_split(points[rows, f], y[rows], w[rows]) for f in range(points.shape[1])]
        feature = int(np.argmin([s for s, _ in splits]))
        if not np.isfinite(splits[feature][0]):
            continue
        threshold = splits[feature][1]
        under = points[rows, feature] <= threshold
        if under.all() or not under.any():
            continue
        tree["feature"][at], tree["threshold"][at] = feature, threshold
        for side, part in (("below", rows[under]), ("above", rows[~under])):
            tree[side][at] = node(int(np.bincount(y[part], w[part]).argmax()))
            todo.append((tree[side][at], part, left - 1))
    return tree


def votes(trees: dict[str, np.ndarray], points: np.ndarray) -> np.ndarray:
    """Each tree's label for each point: trees x points."""
    at = np.repeat(trees["roots"][:, None], len(points), axis=1)
    while True:
        feature = trees["feature"][at]
        inner = feature >= 0
        if not inner.any():
            return trees["label"][at]
        value = np.where(feature == 0, points[None, :, 0], points[None, :, 1])
        at = np.where(inner, np.where(value <= trees["threshold"][at], trees["below"][at], trees["above"][at]), at)


def majority(labels: np.ndarray, counted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The label most trees give to each point (ties: the least), and how many trees counted."""
    names, code = np.unique(labels, return_inverse=True)
    code = code.reshape(labels.shape)
    counted = np.ones(labels.shape, bool) if counted is None else counted
    tally = np.stack([((code == c) & counted).sum(0) for c in range(len(names))])
    return names[tally.argmax(0)], counted.sum(0)


def fit_forest(points: np.ndarray, labels: np.ndarray, trees: int, depth: int, rate: float, rng: np.random.Generator) -> dict:
    """A forest as flat arrays, with the rows that some tree left out and how many of them the others' votes name right."""
    names, y = np.unique(labels, return_inverse=True)
    drawn = rng.poisson(rate, (trees, len(points))).astype(float)
    drawn[drawn.sum(1) == 0] = 1.0
    grown = [grow(points, y, w, depth) for w in drawn]
    sizes = [len(t["label"]) for t in grown]
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    forest = {k: np.concatenate([np.asarray(t[k]) for t in grown]) for k in ("feature", "threshold", "below", "above", "label")}
    for side in ("below", "above"):
        forest[side] = np.where(forest[side] >= 0, forest[side] + np.repeat(roots, sizes), -1)
    forest |= {"label": names[forest["label"]], "roots": roots}
    named, many = majority(votes(forest, points), drawn == 0)
    return forest | {"rows": len(points), "oob_rows": int((many > 0).sum()), "oob_correct": int(((named == labels) & (many > 0)).sum())}


def _cell(column: str, degrees: float) -> Column:
    return F.floor(F.col(column) / degrees).cast("int")


def _with_cell(df: DataFrame, degrees: float) -> DataFrame:
    return df.withColumns({"cell_lat": _cell("lat", degrees), "cell_lon": _cell("lon", degrees)})


def _points(table: pa.Table) -> np.ndarray:
    return np.column_stack([table.column(c).to_numpy() for c in ("lat", "lon")])


def fit_forests(
    rows: DataFrame, seed: int, cell_degrees: float, cell_rows: int, trees: int = 100, depth: int = 25, rate: float = 0.8
) -> DataFrame:
    """The table of forests of ``rows`` (lat, lon, cluster, rank): one per cell that has rows with a position.

    A cell's forest sees its first ``cell_rows`` rows by ``rank``.
    """
    celled = _with_cell(rows.where("lat is not null and lon is not null and cluster is not null"), cell_degrees)
    spread = celled.groupBy(*CELL).agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi"), F.count(F.lit(1)).alias("rows"))
    spread = cut(spread)
    empty = {name: F.array().cast(kind) for name, kind in (f.strip().split(" ", 1) for f in _TREES.split(","))}
    plain = spread.where("lo = hi").select(
        *CELL, "rows", F.col("rows").alias("oob_rows"), F.col("rows").alias("oob_correct"),
        *[(F.array(F.col("lo")) if name == "label" else value).alias(name) for name, value in empty.items()],
    )
    nth = F.row_number().over(Window.partitionBy(*CELL).orderBy("rank"))
    mixed = celled.join(spread.where("lo <> hi").select(*CELL), list(CELL), "left_semi").withColumn("nth", nth).where(F.col("nth") <= cell_rows)
    schema = pa.schema([("cell_lat", pa.int32()), ("cell_lon", pa.int32()), ("rows", pa.int64()), ("oob_rows", pa.int64()), ("oob_correct", pa.int64())] + [(n, pa.list_(t)) for n, t in (("feature", pa.int32()), ("threshold", pa.float64()), ("below", pa.int32()), ("above", pa.int32()), ("label", pa.int64()), ("roots", pa.int32()))])

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        lat, lon = (k.as_py() for k in key)
        table = table.sort_by("nth")
        rng = np.random.default_rng([seed, lat + 2**31, lon + 2**31])
        forest = fit_forest(_points(table), table.column("cluster").to_numpy(), trees, depth, rate, rng)
        row = {"cell_lat": lat, "cell_lon": lon} | {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in forest.items()}
        return pa.Table.from_pylist([row], schema)

    fitted = mixed.select(*CELL, "nth", "lat", "lon", F.col("cluster").cast("bigint").alias("cluster")).groupBy(*CELL).applyInArrow(fit, _FOREST)
    return plain.unionByName(fitted)


def classify(df: DataFrame, forests: DataFrame, cell_degrees: float, key: str = "track") -> DataFrame:
    """(key, cluster) of every row of ``df`` (key, lat, lon); noise where no labelled row was near or a position lacks."""
    points = cut(_with_cell(df.select(key, "lat", "lon"), cell_degrees))
    single = F.when(F.size("feature") == 0, F.col("label")[0])
    kinds = cut(forests.select(*CELL, single.alias("cluster"), (F.size("feature") > 0).alias("mixed")))
    known = points.join(kinds, list(CELL), "left")
    settled = known.where("not coalesce(mixed, false)").select(key, F.coalesce("cluster", F.lit(NOISE)).cast("bigint").alias("cluster"))
    counts = cut(known.where("mixed").groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / _PART_ROWS).cast("int").alias("parts")))
    dealt = points.join(counts, list(CELL)).select(*CELL, F.pmod(F.xxhash64(key), F.col("parts")).cast("int").alias("part"), key, "lat", "lon")
    copies = forests.join(counts, list(CELL)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    kind = points.schema[key].dataType

    def predict(mine: pa.Table, forest: pa.Table) -> pa.Table:
        trees = {c: forest.column(c)[0].values.to_numpy() for c in ("feature", "threshold", "below", "above", "label", "roots")} if mine.num_rows else {}
        named = majority(votes(trees, _points(mine)))[0] if mine.num_rows else np.zeros(0, np.int64)
        return pa.table({key: mine.column(key), "cluster": pa.array(named, pa.int64())})

    cell = [*CELL, "part"]
    answered = dealt.groupBy(*cell).cogroup(copies.groupBy(*cell)).applyInArrow(predict, f"{key} {kind.simpleString()}, cluster bigint")
    return settled.unionByName(answered)


class DestinationModel:
    """The table of forests, stored, with what it takes to classify by it."""

    def __init__(self, forests: DataFrame, cell_degrees: float) -> None:
        self.forests, self.cell_degrees = forests, cell_degrees

    def transform(self, df: DataFrame, key: str = "track") -> DataFrame:
        return classify(df, self.forests, self.cell_degrees, key)


def fit_destination_model(
    labelled: DataFrame, holdout: int = 1000, seed: str = "83845640", cell_degrees: float = 0.5, cell_rows: int = 5000, trees: int = 100, depth: int = 25
) -> tuple[DestinationModel, DataFrame]:
    """(model, report): forests from position to cluster, scored on held-out rows and out of bag.

    ``holdout`` rows are kept from the fit, drawn by a seeded digest of the track; a table without more raises.  A
    cell's forest is fitted on at most ``cell_rows`` rows, drawn alike.  Trees are ``depth`` deep whatever the number
    of clusters.  The report has the rows tested, the correct ones, their share, the wrong ones involving noise, and
    the rows out of bag with the share of them named right.
    """
    rows = cut(shuffled_rank(labelled, seed, F.col("track")).select("track", "lat", "lon", "cluster", "rank"))
    fitted = rows.where(F.col("rank") > holdout)
    if fitted.isEmpty():
        raise ValueError(f"{holdout} rows are held out and none is left to fit on")
    model = DestinationModel(cut(fit_forests(fitted, int(seed), cell_degrees, cell_rows, trees, depth)), cell_degrees)
    tested = rows.where(F.col("rank") <= holdout)
    answers = tested.join(model.transform(tested).withColumnRenamed("cluster", "named"), "track")
    right = F.col("named") == F.col("cluster")
    report = answers.agg(
        F.count(F.lit(1)).alias("tested"), F.count_if(right).alias("correct"), F.avg(right.cast("double")).alias("accuracy"),
        F.count_if(~right & ((F.col("named") == NOISE) | (F.col("cluster") == NOISE))).alias("wrong_with_noise"),
    )
    bag = model.forests.agg(F.sum("oob_rows").alias("oob_rows"), F.try_divide(F.sum("oob_correct"), F.sum("oob_rows")).alias("oob_accuracy"))
    return model, report.join(bag, F.lit(True))
