"""Expected checkout traffic of a store by local hour and time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of full load by local hour [from, until), full load of a
# store, and the share that the thinly populated zones reach.
HOURLY_LOAD = (
    (10, 11, 0.12),
    (11, 13, 1.0),
    (13, 16, 0.25),
    (16, 19, 0.75),
    (19, 22, 0.17),
)
CHECKSTANDS = 10
SCANS_PER_HOUR = 800
ZONE_LOAD = {"HST (GMT-10)": 0.4, "AKST (GMT-09)": 0.4, "MST (GMT-07)": 0.8}


def load_multiplier(hour: Column) -> Column:
    share = F.lit(0.0)
    for start, end, value in HOURLY_LOAD:
        share = F.when((hour >= start) & (hour < end), F.lit(value)).otherwise(share)
    return share


def zone_load(zone_name: Column) -> Column:
    share = F.lit(1.0)
    for zone, value in ZONE_LOAD.items():
        share = F.when(zone_name == zone, F.lit(value)).otherwise(share)
    return share


def scans_per_minute(local_time: Column) -> Column:
    """Scans a store makes in a minute at this local time, before zone and noise."""
    per_minute = CHECKSTANDS * SCANS_PER_HOUR / 60.0
    return F.floor(load_multiplier(F.hour(local_time)) * F.lit(per_minute)).cast("int")


def expected_scans(local_time: Column, zone_name: Column) -> Column:
    return (scans_per_minute(local_time) * zone_load(zone_name)).cast("int")
