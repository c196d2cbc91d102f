"""Scoring predictions: distances, horizons, autoregressive rollout, median stopping."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.geo import CLUSTER_RADIUS_KM, great_circle_km, haversine
from keelson.functions.ordered import CHUNK

KEY = ("track", "window_id")
# Horizons in minutes counted from the common start, and the epochs between stopping checks.
HORIZON_HOURS = (1, 2, 3)
CHECK_EVERY = 30
_EPOCHS_PER_CHUNK = 4096


def haversine_error(
    pred: DataFrame,
    truth: DataFrame,
    ranges: Mapping[str, tuple[float, float]],
    keys: Sequence[str] = (*KEY, "step"),
) -> DataFrame:
    """Error in km of each prediction; both sides are normalized lat/lon.

    A prediction without a truth, or a truth without a prediction, keeps its row with a null error.
    """

    def degrees(side, name):
        low, high = ranges[name]
        return F.col(f"{side}_{name}") * (high - low) + low

    p = pred.select(*keys, F.col("lat").alias("pred_lat"), F.col("lon").alias("pred_lon"))
    t = truth.select(*keys, F.col("lat").alias("true_lat"), F.col("lon").alias("true_lon"))
    km = haversine(degrees("true", "lat"), degrees("true", "lon"), degrees("pred", "lat"), degrees("pred", "lon"))
    return p.join(t, list(keys), "full").withColumn("error_km", km)


def horizon_steps(gap_minutes: float) -> dict[int, int]:
    """Hour ahead -> index of the future step it is scored at."""
    return {hours: int(hours * 60 / gap_minutes) - 1 for hours in HORIZON_HOURS}


def horizon_errors(df: DataFrame, gap_minutes: float, by: Sequence[str] = ()) -> DataFrame:
    """Mean error one, two and three hours ahead, from rows with ``step_index`` and ``error_km``."""
    hour = F.lit(None).cast("int")
    for ahead, index in horizon_steps(gap_minutes).items():
        hour = F.when(F.col("step_index") == index, F.lit(ahead)).otherwise(hour)
    scored = df.withColumn("hour", hour).where(F.col("hour").isNotNull())
    return scored.groupBy(*by, "hour").agg(F.avg("error_km").alias("mean_km"), F.count("error_km").alias("n"))


def mean_error(df: DataFrame, metric: str = "haversine") -> DataFrame:
    """One row: the training loss over rows with pred_lat/pred_lon and true_lat/true_lon in degrees."""
    if metric == "haversine":
        error = haversine(
            F.col("true_lat"), F.col("true_lon"), F.col("pred_lat"), F.col("pred_lon"), radius=CLUSTER_RADIUS_KM
        )
    elif metric == "mse":
        lat, lon = F.col("true_lat") - F.col("pred_lat"), F.col("true_lon") - F.col("pred_lon")
        error = (lat * lat + lon * lon) / 2
    else:
        raise ValueError(f"unknown metric {metric!r}")
    return df.agg(F.avg(error).alias("loss"))


def advance_state(df: DataFrame, predicted: Mapping[str, Column], gap_minutes: float) -> DataFrame:
    """One autoregressive step: the oldest step leaves, the prediction joins.

    The new step copies the last one, then takes the predicted columns.  If the state has
    ``distance_traveled`` it becomes the km from the second-oldest step to the prediction;
    ``hour`` moves on once an hour's worth of steps has passed since it last changed, and
    ``day_of_week`` with it past 23.
    """
    state = F.col("state")
    fields = df.schema["state"].dataType.elementType.fieldNames()
    last = F.element_at(state, -1)
    new = {f: last[f] for f in fields} | dict(predicted)
    if "distance_traveled" in fields:
        second = state[1]
        new["distance_traveled"] = haversine(second["lat"], second["lon"], new["lat"], new["lon"])
    if "day_of_week" in fields:
        changed = F.transform(
            F.sequence(F.lit(0), F.size(state) - 2),
            lambda i: F.when(F.get(state, i + 1)["hour"] != F.get(state, i)["hour"], i),
        )
        last_change = F.coalesce(F.array_max(changed), F.lit(-1))
        hour = last["hour"] + F.when(last_change + 60.0 / gap_minutes < F.size(state), 1).otherwise(0)
        new["day_of_week"] = (last["day_of_week"] + F.when(hour > 23, 1).otherwise(0)) % 7
        new["hour"] = hour % 24
    types = {f.name: f.dataType for f in df.schema["state"].dataType.elementType.fields}
    step = F.struct(*[new[f].cast(types[f]).alias(f) for f in fields])
    return df.withColumn("state", F.concat(F.slice(state, 2, F.size(state) - 1), F.array(step)))


@dataclass(frozen=True)
class Feedback:
    """What a fed-back prediction means: the features of a step in order, and those among them that the model predicts.

    ``ranges`` are those the features were normalized with; without them values are in original units.
    """

    features: tuple[str, ...]
    outputs: tuple[str, ...] = ("lat", "lon")
    gap_minutes: float = 60.0
    ranges: Mapping[str, tuple[float, float]] | None = None

    def read(self, values: np.ndarray, name: str) -> np.ndarray:
        """A feature in original units."""
        low, high = (self.ranges or {}).get(name, (0.0, 1.0))
        return values * (high - low) + low

    def store(self, values: np.ndarray, name: str) -> np.ndarray:
        low, high = (self.ranges or {}).get(name, (0.0, 1.0))
        return (values - low) / (high - low) if high != low else np.zeros_like(values)


def advance(windows: np.ndarray, predicted: np.ndarray, feedback: Feedback) -> np.ndarray:
    """:func:`advance_state` for a batch: windows x steps x features, and windows x outputs."""
    at = {name: i for i, name in enumerate(feedback.features)}
    steps = windows.shape[1]
    new = windows[:, -1].copy()
    for i, name in enumerate(feedback.outputs):
        new[:, at[name]] = predicted[:, i]
    if "distance_traveled" in at:
        ends = [feedback.read(side[:, at[name]], name) for side in (windows[:, 1], new) for name in ("lat", "lon")]
        new[:, at["distance_traveled"]] = feedback.store(great_circle_km(*ends), "distance_traveled")
    if "day_of_week" in at:
        hours = np.rint(feedback.read(windows[:, :, at["hour"]], "hour"))
        changed = hours[:, 1:] != hours[:, :-1]
        last_change = np.where(changed.any(1), steps - 2 - changed[:, ::-1].argmax(1), -1)
        hour = hours[:, -1] + (last_change + 60.0 / feedback.gap_minutes < steps)
        day = np.rint(feedback.read(windows[:, -1, at["day_of_week"]], "day_of_week")) + (hour > 23)
        new[:, at["day_of_week"]] = feedback.store(day % 7, "day_of_week")
        new[:, at["hour"]] = feedback.store(hour % 24, "hour")
    return np.concatenate([windows[:, 1:], new[:, None]], axis=1)


def fed_back(model: Callable[[np.ndarray], np.ndarray], rounds: int, feedback: Feedback) -> Callable[[np.ndarray], np.ndarray]:
    """A one-step model as one of ``rounds`` steps: each prediction (windows x outputs) becomes the next one's last step."""

    def ahead(windows: np.ndarray) -> np.ndarray:
        out = []
        for _ in range(rounds):
            predicted = np.asarray(model(windows), float).reshape(len(windows), len(feedback.outputs))
            out.append(predicted)
            windows = advance(windows, predicted, feedback)
        return np.stack(out, axis=1)

    return ahead


def with_predictions(
    df: DataFrame, model: Callable[[np.ndarray], np.ndarray], outputs: Sequence[str] = ("lat", "lon"), sequence: str = "sequence", name: str = "predicted"
) -> DataFrame:
    """Add ``name``: the model's predictions as an array with a struct of ``outputs`` per step ahead.

    ``model`` gets a batch of sequences as windows x steps x features (null: NaN) and returns windows x steps ahead x
    outputs; a model of one step may leave the axis out, one that is fed its own predictions is made by
    :func:`fed_back`.  The whole horizon runs inside the batch, so no stage is stored between steps, and only the
    sequences go to Python.
    """
    columns = list(outputs)

    @F.arrow_udf(f"array<struct<{', '.join(f'{c}: double' for c in columns)}>>")
    def predict(sequences: pa.Array) -> pa.Array:
        n = len(sequences)
        if not n:
            return pa.array([], pa.list_(pa.struct([(c, pa.float64()) for c in columns])))
        steps = sequences.flatten()
        values = steps.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, len(steps) // n, -1)
        out = np.asarray(model(values), float).reshape(n, -1, len(columns))
        flat = pa.StructArray.from_arrays([pa.array(out[:, :, i].ravel(), from_pandas=True) for i in range(len(columns))], names=columns)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * out.shape[1]), flat)

    return df.withColumn(name, predict(F.col(sequence)))


def predicted_steps(df: DataFrame, keys: Sequence[str] = KEY, name: str = "predicted") -> DataFrame:
    """One row per window and step ahead: the keys, ``step_index`` from 0, and a ``pred_`` column per output."""
    outputs = df.schema[name].dataType.elementType.fieldNames()
    rows = df.select(*keys, F.posexplode(name).alias("step_index", "_p"))
    return rows.select(*keys, "step_index", *[F.col("_p")[c].alias(f"pred_{c}") for c in outputs])


def step_errors(df: DataFrame, keys: Sequence[str] = KEY, predicted: str = "predicted", true: str = "true") -> DataFrame:
    """(keys, step_index, pred_lat, pred_lon, true_lat, true_lon, error_km) of every step ahead of windows that hold both.

    ``predicted`` and ``true`` are arrays of structs with lat and lon in degrees; a step that one side lacks is null.
    Both are in the window's row, so errors need no join.
    """
    rows = df.select(*keys, F.posexplode(F.arrays_zip(F.col(predicted).alias("p"), F.col(true).alias("t"))).alias("step_index", "_s"))
    named = {f"{kind}_{c}": F.col("_s")[side][c] for kind, side in (("pred", "p"), ("true", "t")) for c in ("lat", "lon")}
    flat = rows.select(*keys, "step_index", *[value.alias(n) for n, value in named.items()])
    return flat.withColumn("error_km", haversine(F.col("true_lat"), F.col("true_lon"), F.col("pred_lat"), F.col("pred_lon")))


def score(df: DataFrame, predict: Callable[[pd.Series], pd.DataFrame], columns: Sequence[str] = ("pred_lat", "pred_lon")):
    """Run a user's model over ``sequence`` arrays, a batch of windows at a time.

    ``predict`` gets the batch's sequences and returns one row per sequence.  This is the
    one place where user Python runs; batches move through Arrow and stay bounded.
    """
    schema = ", ".join(["track bigint", "window_id bigint", *[f"{c} double" for c in columns]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = predict(batch["sequence"])
            out.columns = list(columns)
            yield pd.concat([batch[list(KEY)].reset_index(drop=True), out.reset_index(drop=True)], axis=1)

    return df.select(*KEY, "sequence").mapInPandas(run, schema)


def _running(df: DataFrame, keys: Sequence[str], kind, column: str, name: str) -> DataFrame:
    """Running sum or minimum along ``steps`` within keys, chunk by chunk."""
    rows = df.withColumn(CHUNK, F.floor(F.col("steps") / _EPOCHS_PER_CHUNK))
    inside = Window.partitionBy(*keys, CHUNK).orderBy("steps")
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*keys, CHUNK).agg(kind(column).alias("_part")).select(
        *keys, CHUNK, kind("_part").over(before).alias("_before")
    )
    joined = rows.withColumn("_here", kind(column).over(inside)).join(carried, [*keys, CHUNK])
    total = F.least("_here", "_before") if kind is F.min else F.col("_here") + F.coalesce("_before", F.lit(0.0))
    return joined.withColumn(name, total).drop(CHUNK, "_here", "_before")


def running_means(metrics: DataFrame) -> DataFrame:
    """Add ``average_loss``: mean loss of a run up to each step (``steps`` counts from 1)."""
    summed = _running(metrics, ["run", "experiment_id"], F.sum, "loss", "_sum")
    return summed.withColumn("average_loss", F.col("_sum") / F.col("steps")).drop("_sum")


def median_cutoffs(metrics: DataFrame) -> DataFrame:
    """(experiment_id, steps, average_loss): median over runs of their running mean loss."""
    return running_means(metrics).groupBy("experiment_id", "steps").agg(F.median("average_loss").alias("average_loss"))


def stopping_decisions(metrics: DataFrame, cutoffs: DataFrame, every: int = CHECK_EVERY) -> DataFrame:
    """At every check epoch, whether a run's best loss so far is above the cutoff; no cutoff never stops."""
    best = _running(metrics, ["run", "experiment_id"], F.min, "loss", "best_loss").where(F.col("steps") % every == 0)
    limits = cutoffs.withColumnRenamed("average_loss", "cutoff")
    return best.join(limits, ["experiment_id", "steps"], "left").withColumn(
        "stop", F.coalesce(F.col("best_loss") > F.col("cutoff"), F.lit(False))
    )


def evaluation_summary(df: DataFrame) -> DataFrame:
    """Mean error per split and hour ahead."""
    return df.groupBy("split", "hour").agg(F.avg("error_km").alias("mean_km"), F.count("error_km").alias("n"))
