"""Reading, landing and uniting raw position messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.config import Box

# The raw message columns in file order.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("MMSI", T.StringType()),
        T.StructField("BaseDateTime", T.StringType()),
        T.StructField("LAT", T.DoubleType()),
        T.StructField("LON", T.DoubleType()),
        T.StructField("SOG", T.DoubleType()),
        T.StructField("COG", T.DoubleType()),
        T.StructField("Heading", T.DoubleType()),
        T.StructField("VesselName", T.StringType()),
        T.StructField("IMO", T.StringType()),
        T.StructField("CallSign", T.StringType()),
        T.StructField("VesselType", T.DoubleType()),
        T.StructField("Status", T.StringType()),
        T.StructField("Length", T.DoubleType()),
        T.StructField("Width", T.DoubleType()),
        T.StructField("Draft", T.DoubleType()),
        T.StructField("Cargo", T.DoubleType()),
        T.StructField("TransceiverClass", T.StringType()),
    ]
)
IDENTITY_COLUMNS = ("VesselName", "IMO", "CallSign")


#: Other spellings of raw columns.
_SPELLINGS = {"transcieverclass": "TransceiverClass"}


def read_messages(spark: SparkSession, path, file_format: str = "csv", bad_record: str | None = None) -> DataFrame:
    """Raw messages with fixed types; nothing is inferred from the data.

    CSV columns go by the name in the header, in any order and either spelling; a file set without some column has
    nulls there, one with an unknown column raises, and so does a file whose header differs from the others'.  A line
    that does not fit the types raises when it is read, or with ``bad_record`` is kept as text in a column of that name.
    """
    if file_format != "csv":
        return spark.read.schema(MESSAGE_SCHEMA).format(file_format).load(path)
    known = {f.name.lower(): f for f in MESSAGE_SCHEMA.fields}
    header = spark.read.option("header", True).csv(path).columns
    names = {c: _SPELLINGS.get(c.strip().lower(), c.strip()) for c in header}
    strange = [c for c, n in names.items() if n.lower() not in known]
    if strange:
        raise ValueError(f"unknown columns {strange} in {path}")
    fields = [T.StructField(c, known[names[c].lower()].dataType) for c in header]
    reader = spark.read.option("header", True)
    if bad_record:
        schema = T.StructType([*fields, T.StructField(bad_record, T.StringType())])
        rows = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_record).option("enforceSchema", False).csv(path)
    else:
        rows = reader.schema(T.StructType(fields)).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
    found = {known[names[c].lower()].name: F.col(f"`{c}`") for c in header}
    columns = [found.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in MESSAGE_SCHEMA.fields]
    return rows.select(*columns, *([bad_record] if bad_record else []))


def bbox_filter(df: DataFrame, box: Box, lat: str = "LAT", lon: str = "LON") -> DataFrame:
    """Rows strictly inside the box on all four sides."""
    return df.where(
        (F.col(lat) < box.lat_2) & (F.col(lat) > box.lat_1) & (F.col(lon) < box.lon_2) & (F.col(lon) > box.lon_1)
    )


def land_messages(df: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Drop identity columns, order by ship and time, write parquet and read it back.

    Rows are range-partitioned on (ship, time), so a ship with very many rows spreads over
    several files and each file is sorted throughout.  A missing ``event_id`` is numbered
    here, where writing it makes it permanent.
    """
    slim = df.drop(*IDENTITY_COLUMNS)
    if "event_id" not in slim.columns:
        slim = slim.withColumn("event_id", F.monotonically_increasing_id())
    order = ["MMSI", "BaseDateTime"]
    placed = slim.repartitionByRange(files, *order) if files else slim.repartitionByRange(*order)
    placed.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def union_zones(zones: Mapping[str, DataFrame]) -> DataFrame:
    """Zone files of one period as one dataset, each row tagged with its ``zone``."""
    tagged = [df.withColumn("zone", F.lit(name)) for name, df in zones.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
