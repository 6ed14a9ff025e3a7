"""Time functions on zone-less store-local timestamps.

Everything here works on ``timestamp_ntz``, so no result depends on the
session time zone. Text that is no time becomes NULL.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The scan time format, the zone of the dashboards, opening hours
# of the price desk (both ends included) and the offset inside a zone's name.
SCAN_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SCAN_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
REPORT_ZONE = "America/Los_Angeles"
OPENING_TIME = "09:00:00"
CLOSING_TIME = "17:00:00"
ZONE_OFFSET = r"GMT([+-]\d{2})"


def parse_scan_time(text: Column) -> Column:
    """Text of exactly ``yyyy-MM-dd HH:mm:ss`` to a timestamp, else NULL."""
    return F.when(text.rlike(SCAN_TIME_SHAPE), text.try_cast("timestamp_ntz"))


def parse_any_time(text: Column) -> Column:
    """Text in Spark's default timestamp format to a timestamp, else NULL."""
    return text.try_cast("timestamp_ntz")


def scan_date(ts: Column) -> Column:
    return ts.cast("date")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def format_time(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; fractions of a second are cut off."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)


def clock_text(ts: Column) -> Column:
    """``HH:mm:ss`` of a timestamp."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 12, 8)


def date_in_zone(utc: Column, zone: str = REPORT_ZONE) -> Column:
    """Calendar date in ``zone`` at a UTC instant given without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date")


def today_in_zone(zone: str = REPORT_ZONE) -> dt.date:
    """Today's date in ``zone``, the default argument of scheduled jobs."""
    return dt.datetime.now(ZoneInfo(zone)).date()


def zone_offset_hours(zone_name: Column) -> Column:
    """Whole hours in a name such as ``PST (GMT-08)``; 0 when there are none."""
    hours = F.regexp_extract(zone_name, ZONE_OFFSET, 1).try_cast("int")
    return F.coalesce(hours, F.lit(0))


def utc_to_local(utc: Column, zone_name: Column) -> Column:
    return F.timestamp_add("HOUR", zone_offset_hours(zone_name), utc)


def in_business_hours(ts: Column) -> Column:
    """Between 09:00 and 17:00, both included to the microsecond."""
    clock = F.substring(ts.cast("timestamp_ntz").cast("string"), 12, 15)
    return clock.between(OPENING_TIME, CLOSING_TIME)


def is_due(scheduled: Column, now: Column) -> Column:
    return scheduled <= now


def stamp(df: DataFrame, name: str, as_of: dt.datetime | None = None) -> DataFrame:
    """Add a processing time; ``as_of`` replaces the clock in re-runs and tests."""
    return df.withColumn(name, F.current_timestamp() if as_of is None else F.lit(as_of))


def with_scan_time(scans: DataFrame, name: str = "scan_ts") -> DataFrame:
    """Make sure a typed scan time exists: a typed column wins over the text."""
    if name in scans.columns:
        return scans
    return scans.withColumn(name, parse_scan_time(F.col("scan_datetime")))


def scans_between(
    scans: DataFrame,
    first: dt.date | None = None,
    until: dt.date | None = None,
    name: str = "scan_ts",
) -> DataFrame:
    """Scans with ``first <= time < until``, pruned at the source.

    A predicate on a parsed text cannot reach the files, but the fixed format
    sorts like the time it denotes, so the same bounds are also put on the text
    column, where min/max statistics can skip row groups. Where the table is
    partitioned by ``scan_datestamp``, the day of the scan, only the folders of
    these days are read.
    """
    typed = with_scan_time(scans, name)
    text = "scan_datetime" in scans.columns and name not in scans.columns
    for bound, below in ((first, False), (until, True)):
        if bound is None:
            continue
        midnight = dt.datetime.combine(bound, dt.time())
        limit = F.lit(midnight).cast("timestamp_ntz")
        as_text = F.lit(f"{bound.isoformat()} 00:00:00")
        typed = typed.where(F.col(name) < limit if below else F.col(name) >= limit)
        if "scan_datestamp" in scans.columns:
            day = F.col("scan_datestamp")
            typed = typed.where(day < F.lit(bound) if below else day >= F.lit(bound))
        if text:
            column = F.col("scan_datetime")
            typed = typed.where(column < as_text if below else column >= as_text)
    return typed


def event_time(scans: DataFrame, name: str = "scan_ts") -> DataFrame:
    """The scan time as a zoned timestamp, which stream watermarks need."""
    return scans.withColumn(name, F.col(name).cast("timestamp"))
