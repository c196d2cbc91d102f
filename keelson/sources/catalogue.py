"""The calendar of source files: which should exist, which are missing, what each may hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.geo import utm_zone

# Years published per zone and month, years published per day.
ZONE_YEARS = (2015, 2016, 2017)
DAY_YEARS = (2018, 2019, 2020, 2021)


def zones_of_box(df: DataFrame, lat_1: str, lon_1: str, lat_2: str, lon_2: str) -> DataFrame:
    """One row per UTM zone between the two corners of each row's box (column ``zone``)."""
    first = utm_zone(F.col(lat_1), F.col(lon_1))
    last = utm_zone(F.col(lat_2), F.col(lon_2))
    return df.withColumn("zone", F.explode(F.sequence(F.least(first, last), F.greatest(first, last))))


def expected_partitions(years: DataFrame, zones: DataFrame, extension: str) -> DataFrame:
    """Every source file the years and zones call for.

    ``years(year)`` and ``zones(zone)`` are short distinct lists.  Zone years have a file
    per month and zone, day years a file per day; any other year raises.
    """
    known = F.col("year").isin(*ZONE_YEARS, *DAY_YEARS)
    checked = years.distinct().withColumn(
        "year", F.when(known, F.col("year")).otherwise(
            F.raise_error(F.concat(F.lit("no file layout known for year "), F.col("year").cast("string"))).cast("int")
        )
    )
    zone_list = zones.agg(F.sort_array(F.collect_set(F.col("zone").cast("int"))).alias("zones"))
    monthly = (
        checked.where(F.col("year").isin(*ZONE_YEARS))
        .join(F.broadcast(zone_list), F.lit(True))
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
        .withColumn("zone_or_day", F.explode("zones"))
        .withColumn("layout", F.lit("_Zone"))
    )
    first = F.make_date(F.col("year"), F.lit(1), F.lit(1))
    last = F.make_date(F.col("year"), F.lit(12), F.lit(31))
    daily = (
        checked.where(F.col("year").isin(*DAY_YEARS))
        .withColumn("date", F.explode(F.sequence(first, last)))
        .withColumn("month", F.month("date"))
        .withColumn("zone_or_day", F.dayofmonth("date"))
        .withColumn("layout", F.lit("_"))
    )
    columns = ["year", "month", "zone_or_day", "layout"]
    name = F.format_string(
        f"%d/AIS_%d_%02d%s%02d.{extension}", "year", "year", "month", "layout", "zone_or_day"
    )
    return (
        monthly.select(*columns)
        .unionByName(daily.select(*columns))
        .select("year", "month", "zone_or_day", name.alias("specifier"))
    )


def missing_partitions(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected files that are absent, each row with how many remain and how many there are."""
    total = expected.agg(F.count(F.lit(1)).alias("total"))
    absent = expected.join(present.select("specifier").distinct(), "specifier", "left_anti")
    remaining = absent.agg(F.count(F.lit(1)).alias("remaining"))
    return absent.join(F.broadcast(total), F.lit(True)).join(F.broadcast(remaining), F.lit(True))


def parse_specifier(df: DataFrame, column: str) -> DataFrame:
    """Split a file path into year, month, zone_or_day and extension; an unknown form raises.

    The last part of the path is ``AIS_year_month_place.extension`` below some folder; the place is a day, ``Zone``
    and a zone, or ``*``.
    """
    path = F.col(column)
    file = F.element_at(F.split(path, "/"), -1)
    stem = F.substring_index(file, ".", 1)
    piece = [F.get(F.split(stem, "_"), F.lit(i)) for i in range(5)]
    place = F.when(piece[3].startswith("Zone"), F.substr(piece[3], F.lit(5))).otherwise(piece[3])
    extension = F.substr(file, F.length(stem) + 2)

    def digits(value, n: int):
        return (F.length(value) == n) & F.translate(value, "0123456789", "").eqNullSafe("")

    known = (
        (F.size(F.split(path, "/")) > 1) & (piece[0] == "AIS") & piece[4].isNull() & (extension != "")
        & digits(piece[1], 4) & digits(piece[2], 2) & (digits(place, 2) | (place == "*"))
    )
    bad = F.raise_error(F.concat(F.lit("unknown file name: "), path)).cast("string")
    parts = {"year": piece[1], "month": piece[2], "zone_or_day": place, "extension": extension}
    return df.withColumns({n: F.when(path.isNull(), None).when(known, c).otherwise(bad) for n, c in parts.items()})


def partition_time_bounds(df: DataFrame) -> DataFrame:
    """First and last unix second a file may hold, from year, month and zone_or_day."""
    year, month = F.col("year").cast("int"), F.col("month").cast("int")
    month_start = F.make_date(year, month, F.lit(1))
    day = F.make_date(year, month, F.expr("try_cast(zone_or_day AS int)"))
    by_zone = year.isin(*ZONE_YEARS)
    known = by_zone | year.isin(*DAY_YEARS)
    bad = F.raise_error(F.concat(F.lit("no file layout known for year "), year.cast("string"))).cast("date")
    start = F.when(by_zone, month_start).when(known, day).otherwise(bad)
    end = F.when(by_zone, F.last_day(month_start)).otherwise(day)
    return df.withColumns(
        {
            "min_time": F.unix_date(start).cast("bigint") * 86_400,
            "max_time": F.unix_date(end).cast("bigint") * 86_400 + 86_399,
        }
    )
