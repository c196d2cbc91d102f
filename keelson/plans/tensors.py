"""Model input as stored: positions, one-hot groups and ocean currents of every window, each in a form of its own size.

A step of a window has the columns of ``features`` as doubles, a level number for each categorical column, and the
stamp of the currents in force.  What belongs to a level or a stamp is stored once: the levels learned from training
rows, and for each stamp the filled u and v of every cell as 16-bit numbers.  Reading joins them to the steps after the
windows were cut, so that neither a one-hot column nor a current is copied into a window or goes through its shuffle.

Folder: ``windows`` by dataset, time_gap and x_or_y; ``levels`` (column, level, code); ``currents`` (stamp, u, v), where
the row without stamp has the training means for times without currents; ``cells`` (latitude, longitude of each cell).
A level that training rows lack has no code and no true column, as a null has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.config import Config
from keelson.operators import currents as water
from keelson.operators import windows

STAMP_SECONDS = water.STAMP_HOURS * 3600


def learned_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, level, code) of the categories in the training rows of ``df``; codes count from 0 in order of level.

    Levels are counted by Spark and never collected, so that thousands of destinations are welcome.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns]))
    seen = df.where(F.col("split") == "train").select(pairs).where("level is not null").distinct()
    sorted_levels = seen.groupBy("column").agg(F.array_sort(F.collect_set("level")).alias("levels"))
    return sorted_levels.select("column", F.posexplode("levels").alias("code", "level")).select("column", "level", "code")


def with_codes(df: DataFrame, levels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``codes``: the level number of each categorical column, null for a level that was not learned."""
    out = df
    for i, name in enumerate(columns):
        mine = levels.where(F.col("column") == name).select(F.col("level").alias(f"_level_{i}"), F.col("code").alias(f"_code_{i}"))
        out = out.join(mine, F.col(name).cast("string") == F.col(f"_level_{i}"), "left")
    coded = out.withColumn("codes", F.array(*[F.col(f"_code_{i}") for i in range(len(columns))]))
    return coded.drop(*[f"_{kind}_{i}" for kind in ("level", "code") for i in range(len(columns))])


def stamp_of(seconds: Column) -> Column:
    return seconds - F.pmod(seconds, F.lit(STAMP_SECONDS))


def current_values(df: DataFrame, packed: DataFrame) -> DataFrame:
    """(stamp, u, v, cells) of packed currents, filled with the means over the training rows of ``df``; those without stamp."""
    frame = water.mean_currents(df.where(F.col("split") == "train"), packed)
    midnight = F.unix_date(F.make_date("year", "month", "day")) * F.lit(86400).cast("bigint")
    filled = water.fill_packed(packed, frame).select((midnight + F.col("hour") * 3600).alias("stamp"), "currents")
    every = filled.unionByName(frame.select(F.lit(None).cast("bigint").alias("stamp"), F.col("frame").alias("currents")))
    small = [F.col(f"currents.{name}").cast("array<smallint>").alias(name) for name in ("u", "v")]
    return every.select("stamp", *small, F.transform("currents", lambda cell: F.struct(cell["lat"], cell["lon"])).alias("cells"))


def write_full(df: DataFrame, path: str, cfg: Config, features: Sequence[str], categories: Sequence[str], packed: DataFrame) -> DataFrame:
    """Write all windows of resampled rows with their groups; the shape of every part (:func:`full_shapes`).

    ``df`` is read several times, so it should be stored.
    """
    spark = df.sparkSession
    learned_levels(df, categories).write.mode("overwrite").parquet(f"{path}/levels")
    values = current_values(df, packed)
    values.select("stamp", "u", "v").write.mode("overwrite").parquet(f"{path}/currents")
    values.where("stamp is null").select(F.posexplode("cells").alias("at", "cell")).select("at", "cell.*").toDF("at", "latitude", "longitude").write.mode("overwrite").parquet(f"{path}/cells")
    rows = with_codes(df, spark.read.parquet(f"{path}/levels"), categories).withColumns(
        {"sequence": F.array(*[F.col(f).cast("double") for f in features]), "stamp": stamp_of(F.col("base_datetime").cast("bigint"))}
    )
    groups = ["sequence", "codes", "stamp"]
    parts = windows.parts_of(windows.windows_of(windows.window_blocks(rows, cfg, groups), cfg, windows.dataset_cuts(cfg)), cfg, groups)
    parts.write.mode("overwrite").partitionBy("dataset", "time_gap", "x_or_y").parquet(f"{path}/windows")
    return full_shapes(spark, path, parts.schema)


def layout(spark: SparkSession, path: str, features: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """(position, column, level) of every feature that :func:`read_full` gives, in their order."""
    order = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col("column"))
    levels = spark.read.parquet(f"{path}/levels").select(order.alias("part"), F.col("code").alias("at"), "column", "level")
    cells = spark.read.parquet(f"{path}/cells").select("at", F.concat_ws(",", "latitude", "longitude").alias("level"))
    sides = [cells.select(F.lit(len(categories) + i).cast("bigint").alias("part"), "at", F.lit(name).alias("column"), "level") for i, name in ((1, "water_u"), (2, "water_v"))]
    own = F.inline(F.array(*[F.struct(F.lit(0).cast("bigint").alias("part"), F.lit(i).alias("at"), F.lit(f).alias("column"), F.lit(None).cast("string").alias("level")) for i, f in enumerate(features)]))
    every = spark.range(1).select(own).unionByName(levels).unionByName(sides[0]).unionByName(sides[1])
    numbered = every.agg(F.array_sort(F.collect_list(F.struct("part", "at", "column", "level"))).alias("all"))  # one entry a feature
    return numbered.select(F.posexplode("all").alias("position", "f")).select("position", "f.column", "f.level")


def full_shapes(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """(dataset, time_gap, x_or_y, sequences, steps, features) of every part; nothing is expanded for it.

    ``schema`` is that of the windows, needed only where there may be none.
    """
    stored = spark.read if schema is None else spark.read.schema(schema)
    parts = stored.parquet(f"{path}/windows").groupBy("dataset", "time_gap", "x_or_y").agg(
        F.count(F.lit(1)).alias("sequences"),
        F.max(F.size("sequence")).cast("bigint").alias("steps"),
        F.max(F.size(F.col("sequence")[0])).cast("bigint").alias("own"),
    )
    hot = spark.read.parquet(f"{path}/levels").agg(F.count(F.lit(1)).alias("hot"))
    cells = spark.read.parquet(f"{path}/cells").agg((2 * F.count(F.lit(1))).alias("water"))
    return parts.join(hot, F.lit(True)).join(cells, F.lit(True)).select("dataset", "time_gap", "x_or_y", "sequences", "steps", (F.col("own") + F.col("hot") + F.col("water")).alias("features"))


def read_full(spark: SparkSession, path: str, dataset: str, time_gap: int, x_or_y: str, categories: Sequence[str]) -> DataFrame:
    """(track, window_id, sequence) of one part, steps x features of doubles: columns, one-hot levels, u and v of each cell.

    Other parts are pruned by directory.  Steps meet their currents by stamp; what is put together again by window
    are 16-bit numbers, which become doubles last.
    """
    part = spark.read.parquet(f"{path}/windows").where((F.col("dataset") == dataset) & (F.col("time_gap") == time_gap) & (F.col("x_or_y") == x_or_y))
    steps = part.select("track", "window_id", F.posexplode(F.arrays_zip("sequence", "codes", "stamp")).alias("at", "one")).select("track", "window_id", "at", "one.*")
    values = spark.read.parquet(f"{path}/currents")
    means = values.where("stamp is null").select(F.col("u").alias("mean_u"), F.col("v").alias("mean_v"))
    sizes = spark.read.parquet(f"{path}/levels").groupBy("column").count().collect()  # a row for each categorical column
    counts = {r["column"]: r["count"] for r in sizes}
    met = steps.join(values.where("stamp is not null"), "stamp", "left").join(F.broadcast(means), F.lit(True))  # one row
    water_columns = [F.coalesce(name, f"mean_{name}").alias(name) for name in ("u", "v")]
    rows = met.select("track", "window_id", F.struct("at", "sequence", "codes", *water_columns).alias("step"))
    whole = rows.groupBy("track", "window_id").agg(F.array_sort(F.collect_list("step")).alias("steps"))

    def hot(step: Column, i: int, name: str) -> Column:
        size = counts.get(name, 0)
        none = F.array_repeat(F.lit(0.0), size)
        code = step["codes"][i]
        one = F.concat(F.array_repeat(F.lit(0.0), code), F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), F.lit(size - 1) - code))
        return F.when(code.isNull(), none).otherwise(one)

    def expanded(step: Column) -> Column:
        return F.concat(step["sequence"], *[hot(step, i, c) for i, c in enumerate(categories)], *[step[c].cast("array<double>") for c in ("u", "v")])

    return whole.select("track", "window_id", F.transform("steps", expanded).alias("sequence"))
