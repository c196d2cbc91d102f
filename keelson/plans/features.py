"""Feature building as one plan over windows that are rows: the same steps for every dataset and part.

A window is one row with an array per column (``windows.windows_of``), so statistics of a window are expressions on
its row.  Which steps a part reads, which columns it has and how they are scaled is stated per part; all parts of all
datasets come out of one pass over the windows, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.config import Box, Config
from keelson.operators import currents as water
from keelson.operators import features as fx
from keelson.operators import nearest
from keelson.operators import window_features as wf
from keelson.operators import windows
from keelson.operators.windows import x_steps

PARTS = ("x", "y", "recurrent", "dense")


@dataclass(frozen=True)
class Run:
    """Choices of one model run."""

    gap: int
    history_hours: float
    hours_out: float
    model: str = "direct"
    time_of_day: str = "hour_day"
    sog_cog: str = "min_median_max"
    distance_traveled: str = "use"
    weather: str = "ignore"
    destination: str = "ignore"
    recurrent: str = "vt_dst_and_time"


def blocks_for(df: DataFrame, run: Run, cfg: Config) -> DataFrame:
    """The blocks a run's windows are cut from; local time is added to rows, before any is copied."""
    rows = fx.with_local_time(df) if run.time_of_day == "hour_day" else df
    left_out = ("track", "split", "row_index", "row_count", "_chunk", "event_id")
    return windows.window_blocks(rows, cfg, [c for c in rows.columns if c not in left_out])


def _picks(run: Run, cfg: Config) -> list[tuple[str, int, bool]]:
    """(part, step, only in test datasets) of every row that a window gives."""
    history = fx.history_steps(cfg, run.history_hours, run.gap)
    target = fx.target_steps(cfg, run.gap, run.hours_out, run.model)
    further = [s for s in fx.target_steps(cfg, run.gap, run.hours_out, run.model, test=True) if s not in target]
    picks = [(part, s, False) for part in ("x", "recurrent") for s in history]
    return [*picks, ("dense", history[-1], False), *[("y", s, False) for s in target], *[("y", s, True) for s in further]]


def shape(
    whole: DataFrame, run: Run, cfg: Config, ranges: Mapping[str, tuple[float, float]] | None = None, parts: Sequence[str] = PARTS
) -> DataFrame:
    """Rows (dataset, track, window_id, part, step, features) of every window; a feature that a part lacks is null.

    ``recurrent`` and ``dense`` are the halves of x for fusion models: some columns at every step, the others at the
    last.  ``dense`` and one-step targets have no step.  Without ``ranges`` nothing is scaled and y keeps all columns.
    """
    picks = [pick for pick in _picks(run, cfg) if pick[0] in parts]
    history = fx.history_steps(cfg, run.history_hours, run.gap)
    arrays = [name for name, kind in whole.dtypes if kind.startswith("array<")]
    described = whole
    if run.sog_cog in ("min_median_max", "median"):
        described = wf.with_window_stats(described, ("sog", "cog"), run.sog_cog, history)
    if run.distance_traveled == "use":
        ends = (windows.at_steps(F.col(c), history) for c in ("lat", "lon"))
        described = described.withColumn("distance_traveled", wf.travelled(*ends))
    scalars = [c for c in described.columns if c not in (*wf.WINDOW, *arrays)]
    zipped = F.arrays_zip(
        F.array(*[F.lit(part) for part, _, _ in picks]).alias("part"), F.array(*[F.lit(s) for _, s, _ in picks]).alias("step"),
        F.array(*[F.lit(late) for _, _, late in picks]).alias("_late"), *[windows.at_steps(F.col(a), [s for _, s, _ in picks]).alias(a) for a in arrays],
    )
    rows = described.select(*wf.WINDOW, *scalars, F.inline(zipped)).where(~F.col("_late") | F.col("dataset").endswith("_test")).drop("_late")
    stats_replace = run.sog_cog in ("min_median_max", "median")
    x = fx.drop_groups(rows, run.weather, run.destination, run.sog_cog)
    targets = fx.target_names(run.model, run.sog_cog)
    features = [c for c in x.columns if c not in (*wf.WINDOW, "part", "step") and not (stats_replace and c in ("sog", "cog"))]
    recurrent = fx.recurrent_columns(x.select(*features), run.recurrent, run.sog_cog, run.time_of_day)
    has = {"x": features, "recurrent": recurrent, "dense": [c for c in features if c not in recurrent], "y": targets if ranges is not None else features}
    scaled = rows if ranges is None else fx.normalize(rows, ranges)
    named = [c for c in dict.fromkeys([*features, *targets]) if c in scaled.columns]
    steps = ~F.col("part").isin("dense", *(["y"] if run.model == "direct" else []))
    values = [F.when(F.col("part").isin(*[p for p in parts if c in has[p]]), F.col(f"`{c}`")).alias(c) for c in named]
    return scaled.select(*wf.WINDOW, "part", F.when(steps, F.col("step")).alias("step"), *values)


def fit_ranges(whole: DataFrame, run: Run, cfg: Config, box: Box) -> dict[str, tuple[float, float]]:
    """Normalization ranges of a run, measured on the histories of the training dataset as the plan shapes them."""
    trained = whole.where(F.col("dataset") == "train_long_term_train")
    shaped = shape(trained, run, cfg, parts=("x",)).drop("part", *wf.WINDOW, "step")
    raw = [c for c in fx.target_names(run.model, run.sog_cog) if c not in shaped.columns]
    types = dict(shaped.dtypes)
    columns = [c for c in shaped.columns if types[c] not in ("string", "boolean")]
    return fx.factors(fx.fit_normalizer(shaped, box, cfg.years, [c for c in columns if c not in raw]))


def described_history(df: DataFrame, cfg: Config, gap: int, cuts: Sequence[windows.Cut]) -> DataFrame:
    """One row per window of ``df``: the last history step with local time, bearings, distance and path."""
    rows = fx.with_local_time(df)
    columns = ["base_datetime", "lat", "lon", "sog", "cog", "year", "month", "hour", "day_of_week"]
    whole = windows.windows_of(windows.window_blocks(rows, cfg, columns), cfg, cuts)
    history = wf.select_steps(whole, x_steps(cfg, gap))
    return wf.last_steps(wf.with_window_distance(wf.with_window_bearings(history)))


def analysis_dataset(df: DataFrame, stamps: DataFrame, index: DataFrame, cfg: Config, gap: int, cuts: Sequence[windows.Cut]) -> DataFrame:
    """One described row per window: clock, bearing, distance, path, currents around the ship, bins.

    ``df`` holds resampled rows, ``stamps`` packed currents, ``index`` the cells nearest to tiles.  Currents are
    joined after the windows have shrunk to their last step, so no current is copied into a window.
    """
    last = described_history(df, cfg, gap, cuts).withColumnRenamed("hour", "local_hour")
    joined = water.append_packed(last, stamps, fx.describe_currents, train=df.where(F.col("split") == "train"))
    near = nearest.nearest_arrays(nearest.nearest_stats(joined, index), index)
    return fx.with_bins(near.drop("currents", "speeds").withColumnRenamed("local_hour", "hour"))
