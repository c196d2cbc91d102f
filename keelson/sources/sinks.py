"""Stage outputs: split tables, sequence tensors, predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def save_split(df: DataFrame, path: str, partition_by=()) -> tuple[DataFrame, int]:
    """Write a dataset as parquet and return it as read back, with its row count.

    The count is observed while writing, so no second pass is needed.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path), seen.get["n"]


def write_tensors(df: DataFrame, path: str) -> DataFrame:
    """Write (dataset, time_gap, x_or_y, track, window_id, sequence) as parquet folders.

    Returns the shape of every part: sequences, steps, features.
    """
    df.write.mode("overwrite").partitionBy("dataset", "time_gap", "x_or_y").parquet(path)
    return tensor_shapes(df.sparkSession.read.parquet(path))


def tensor_shapes(df: DataFrame) -> DataFrame:
    return df.groupBy("dataset", "time_gap", "x_or_y").agg(
        F.count(F.lit(1)).alias("sequences"),
        F.max(F.size("sequence")).cast("bigint").alias("steps"),
        F.max(F.size(F.col("sequence")[0])).cast("bigint").alias("features"),
    )


def read_tensors(
    spark: SparkSession, path: str, dataset: str, time_gap: int, x_or_y: str, dtype: str | None = None
) -> DataFrame:
    """One part of a tensor folder; other parts are pruned by directory. Key: (track, window_id)."""
    part = spark.read.parquet(path).where(
        (F.col("dataset") == dataset) & (F.col("time_gap") == time_gap) & (F.col("x_or_y") == x_or_y)
    )
    if dtype is not None:
        part = part.withColumn("sequence", F.col("sequence").cast(f"array<array<{dtype}>>"))
    return part.select("track", "window_id", "sequence")


def save_predictions(df: DataFrame, path: str) -> DataFrame:
    """Write predictions and errors by split and horizon; return the table read back."""
    df.write.mode("overwrite").partitionBy("split", "hour").parquet(path)
    return df.sparkSession.read.parquet(path)
