"""Calendar fields of whole unix seconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400


def day_of(seconds) -> Column:
    """Days since 1970-01-01, as bigint."""
    return ((seconds - F.pmod(seconds, F.lit(DAY))) / DAY).cast("bigint")


def date_of(seconds) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), day_of(seconds).cast("int"))


def year_of(seconds) -> Column:
    return F.year(date_of(seconds))


def month_of(seconds) -> Column:
    return F.month(date_of(seconds))


def day_of_month(seconds) -> Column:
    return F.dayofmonth(date_of(seconds))


def hour_of(seconds) -> Column:
    return F.floor(F.pmod(seconds, F.lit(DAY)) / 3600).cast("int")


def seconds_of(stamp) -> Column:
    """Whole unix seconds of a zone-less timestamp column."""
    days = F.unix_date(stamp.cast("date")).cast("bigint")
    of_day = F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)
    return days * DAY + of_day.cast("bigint")


def local_stamp(seconds, zone: str) -> Column:
    """Wall-clock timestamp (without zone) in ``zone`` of unix seconds."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
