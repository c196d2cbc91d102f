"""Sliding windows over resampled tracks, one-hot columns and sequence tensors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.config import Config
from keelson.functions.ordered import with_chunk, with_position


#: Rows to a block of a track, in window lengths: one row in so many goes to two blocks.
_BLOCK_LENGTHS = 8


def _positioned(df: DataFrame, tie: str = "base_datetime") -> DataFrame:
    if "row_index" in df.columns:
        return df
    return with_position(with_chunk(df, ["track"], tie=tie), ["track"], ["base_datetime", tie])


def sliding_windows(df: DataFrame, length: int, stride: int, tie: str = "base_datetime") -> DataFrame:
    """Copy each row into every window of ``length`` consecutive rows that covers it.

    Windows of a track start at rows 0, stride, 2*stride, ...  Adds ``window_id`` (from 0)
    and ``step`` (position in the window).  With ``row_index`` and ``row_count`` present, as
    after resampling, this is a plain explode: no shuffle, no sort.
    """
    df = _positioned(df, tie)
    row, rows = F.col("row_index"), F.col("row_count")
    first = F.ceil(F.greatest(F.lit(0), row - (length - 1)) / stride).cast("bigint")
    last = F.floor(F.least(row, rows - length) / stride).cast("bigint")
    return (
        df.withColumn("window_id", F.explode(F.when((rows >= length) & (last >= first), F.sequence(first, last))))
        .withColumn("step", (F.col("row_index") - F.col("window_id") * stride).cast("int"))
        .drop("row_index", "row_count")
    )


def test_windows(df: DataFrame, cfg: Config) -> DataFrame:
    """Windows whose history parts do not overlap."""
    return sliding_windows(df, cfg.window_length, cfg.history)


def train_windows(df: DataFrame, cfg: Config) -> DataFrame:
    """Overlapping windows, ``window_movement`` seconds apart."""
    return sliding_windows(df, cfg.window_length, cfg.train_stride)


def window_datasets(df: DataFrame, cfg: Config) -> DataFrame:
    """Windows per ``dataset``: train and valid with the training stride, valid and test with the test stride."""
    train = train_windows(df.where(F.col("split").isin("train", "valid")), cfg)
    test = test_windows(df.where(F.col("split").isin("valid", "test")), cfg)
    return train.withColumn("dataset", F.concat("split", F.lit("_long_term_train"))).unionByName(
        test.withColumn("dataset", F.concat("split", F.lit("_long_term_test")))
    )


def learn_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels of each categorical column of the training data (short lists by nature)."""
    row = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace categorical columns by one boolean per learned level; an unknown level is all false."""
    out = df
    for column, values in levels.items():
        out = out.withColumns({f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)) for v in values})
    return out.drop(*levels)


def to_sequences(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ("track", "window_id")) -> DataFrame:
    """One row per window: ``sequence`` = steps x features of doubles, from rows that are already copied into windows.

    A group is one window, so its size is the window length.  From rows that are not, :func:`gathered_windows` gives
    the same and shuffles each row once instead of every copy.
    """
    row = F.struct(F.col("step"), F.array(*[F.col(f).cast("double") for f in features]).alias("values"))
    return df.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(row)), lambda r: r["values"]).alias("sequence")
    )


def x_steps(cfg: Config, gap: int) -> list[int]:
    """History positions kept for a time gap in seconds."""
    return list(range(0, cfg.history, int(gap / cfg.step)))


def y_steps(cfg: Config, gap: int) -> list[int]:
    """Future positions kept for a time gap in seconds."""
    stride = int(gap / cfg.step)
    return list(range(cfg.history + stride - 1, cfg.window_length, stride))


def select_x_steps(df: DataFrame, cfg: Config, gap: int) -> DataFrame:
    return df.where((F.col("step") < cfg.history) & (F.col("step") % int(gap / cfg.step) == 0))


def select_y_steps(df: DataFrame, cfg: Config, gap: int) -> DataFrame:
    stride = int(gap / cfg.step)
    first = cfg.history + stride - 1
    return df.where((F.col("step") >= first) & ((F.col("step") - first) % stride == 0))


@dataclass(frozen=True)
class Cut:
    """How windows are cut from tracks: every ``stride`` rows, from the tracks of some splits (None: all of them)."""

    kind: str
    stride: int
    splits: tuple[str, ...] | None = None


def dataset_cuts(cfg: Config) -> tuple[Cut, ...]:
    """The cuts of :func:`window_datasets`."""
    return Cut("train", cfg.train_stride, ("train", "valid")), Cut("test", cfg.history, ("valid", "test"))


def window_blocks(df: DataFrame, cfg: Config, columns: Sequence[str]) -> DataFrame:
    """(track, split, row_count, block) with an array per column: the rows of some window lengths of a track, in order.

    A block ends with the first rows of the block behind it, so every window that begins in a block lies in it.  This
    is the only shuffle that windows and all their features need, and it moves rows before they are copied.
    """
    length, span = cfg.window_length, _BLOCK_LENGTHS * cfg.window_length
    own = F.floor(F.col("row_index") / span).cast("bigint")
    ahead = (F.col("row_index") % span < length - 1) & (own > 0)
    split = F.col("split") if "split" in df.columns else F.lit(None).cast("string").alias("split")
    rows = _positioned(df).select(
        "track", split, "row_count", F.struct(F.col("row_index").cast("bigint").alias("_at"), *[F.col(c) for c in columns]).alias("row"),
        F.explode(F.when(ahead, F.array(own, own - 1)).otherwise(F.array(own))).alias("block"),
    )
    blocks = rows.groupBy("track", "split", "row_count", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return blocks.select("track", "split", "row_count", "block", *[F.col("rows")[c].alias(c) for c in columns])


def windows_of(blocks: DataFrame, cfg: Config, cuts: Sequence[Cut]) -> DataFrame:
    """One row per window: (dataset, track, window_id), and each column's values by step as an array.

    ``dataset`` is the split and the cut's kind, or the kind alone for a cut of all splits.  No shuffle.
    """
    length, span = cfg.window_length, _BLOCK_LENGTHS * cfg.window_length
    columns = [c for c in blocks.columns if c not in ("track", "split", "row_count", "block")]
    begin = F.col("block") * span

    def starting_here(cut: Cut):
        first = F.ceil(begin / cut.stride).cast("bigint")
        last = F.floor(F.least(begin + span - 1, F.col("row_count") - length) / cut.stride).cast("bigint")
        mine = F.lit(True) if cut.splits is None else F.col("split").isin(*cut.splits)
        ids = F.when(mine & (F.col("row_count") >= length) & (last >= first), F.sequence(first, last))
        dataset = F.lit(cut.kind) if cut.splits is None else F.concat("split", F.lit(f"_long_term_{cut.kind}"))
        found = F.transform(ids, lambda w: F.struct(dataset.alias("dataset"), w.alias("window_id"), (w * cut.stride - begin + 1).cast("int").alias("at")))
        return F.coalesce(found, F.array().cast("array<struct<dataset: string, window_id: bigint, at: int>>"))

    each = blocks.withColumn("_w", F.explode(F.concat(*[starting_here(c) for c in cuts])))
    return each.select("_w.dataset", "track", "_w.window_id", *[F.slice(c, F.col("_w.at"), F.lit(length)).alias(c) for c in columns])


def at_steps(values: Column, steps: Sequence[int]) -> Column:
    """The values of a window at some steps."""
    if list(steps) == list(range(steps[0], steps[0] + len(steps))):
        return F.slice(values, steps[0] + 1, len(steps))
    return F.array(*[F.get(values, F.lit(s)) for s in steps])


def gathered_windows(df: DataFrame, cfg: Config, features: Sequence[str]) -> DataFrame:
    """One row per window of every dataset: (dataset, track, window_id, sequence), sequence = steps x features of doubles.

    The same windows as :func:`window_datasets`, from rows that are shuffled once and before they are copied.
    """
    values = df.withColumn("_values", F.array(*[F.col(f).cast("double") for f in features]))
    whole = windows_of(window_blocks(values, cfg, ["_values"]), cfg, dataset_cuts(cfg))
    return whole.withColumnRenamed("_values", "sequence")


def tensor_parts(df: DataFrame, cfg: Config, features: Sequence[str]) -> DataFrame:
    """X and Y sequences of every time gap: (dataset, time_gap, x_or_y, track, window_id, sequence).

    ``df`` has the resampled rows.  They are shuffled once; the parts are picked from each window's steps.
    """
    return parts_of(gathered_windows(df, cfg, features), cfg, ["sequence"])


def parts_of(whole: DataFrame, cfg: Config, arrays: Sequence[str]) -> DataFrame:
    """The X and Y steps of every time gap from windows that are rows: (dataset, track, window_id, time_gap, x_or_y, arrays)."""
    parts = []
    for gap in cfg.time_gaps:
        for name, steps in (("x", x_steps(cfg, gap)), ("y", y_steps(cfg, gap))):
            picked = [at_steps(F.col(c), steps).alias(c) for c in arrays]
            parts.append(F.struct(F.lit(gap).alias("time_gap"), F.lit(name).alias("x_or_y"), *picked))
    return whole.select("dataset", "track", "window_id", F.inline(F.array(*parts)))
