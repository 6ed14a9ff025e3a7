"""Times, money, traffic and random values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import draws, money, records, temporal, traffic


def one(spark, column, **values):
    row = spark.range(1)
    for name, value in values.items():
        row = row.withColumn(name, F.lit(value))
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text,expected", [
    ("2024-02-29 23:59:59", dt.datetime(2024, 2, 29, 23, 59, 59)),
    ("2023-02-29 00:00:00", None), ("2024-1-05 00:00:00", None), ("2024-01-05", None), ("x", None), ("", None),
    ("2024-01-05 10:10:1 ", None),
])
def test_scan_time(spark, text, expected):
    assert one(spark, temporal.parse_scan_time(F.col("t")), t=text) == expected


def test_times_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        gap = "2024-03-10 02:30:00"  # does not exist there
        ts = temporal.parse_scan_time(F.col("t"))
        assert one(spark, temporal.format_time(ts), t=gap) == gap
        assert one(spark, temporal.date_in_zone(temporal.parse_scan_time(F.col("t"))), t="2024-07-01 06:59:59") == dt.date(2024, 6, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("utc,day", [
    ("2024-01-01 07:59:59", dt.date(2023, 12, 31)), ("2024-01-01 08:00:00", dt.date(2024, 1, 1)),
    ("2024-07-01 07:00:00", dt.date(2024, 7, 1)),
])
def test_report_date(spark, utc, day):
    assert one(spark, temporal.date_in_zone(temporal.parse_scan_time(F.col("t"))), t=utc) == day


@pytest.mark.parametrize("zone,hours", [
    ("PST (GMT-08)", -8), ("X (GMT+05)", 5), ("UTC", 0), ("GMT8", 0), (None, 0),
])
def test_zone_offset(spark, zone, hours):
    assert one(spark, temporal.zone_offset_hours(F.lit(zone).cast("string"))) == hours


@pytest.mark.parametrize("clock,open_", [
    ("08:59:59", False), ("09:00:00", True), ("17:00:00", True), ("17:00:00.000001", False), ("17:00:01", False),
])
def test_business_hours(spark, clock, open_):
    ts = F.lit(f"2024-01-01 {clock}").cast("timestamp_ntz")
    assert one(spark, temporal.in_business_hours(ts)) is open_


def test_month_start(spark):
    ts = F.lit("2024-02-29 13:00:00").cast("timestamp_ntz")
    assert one(spark, temporal.month_start(ts)) == dt.datetime(2024, 2, 1)


def test_stamp(spark):
    fixed = temporal.stamp(spark.range(1), "at", dt.datetime(2024, 1, 1)).first()["at"]
    assert fixed == dt.datetime(2024, 1, 1)
    assert temporal.stamp(spark.range(1), "at").first()["at"] > fixed


def test_text_bound_prunes_and_agrees(spark, folder):
    path = folder("scans")
    rows = [("2024-01-01 23:59:59",), ("2024-01-02 00:00:00",), ("2024-01-02 23:59:59",), ("2024-01-03 00:00:00",), ("bad",), (None,)]
    spark.createDataFrame(rows, "scan_datetime string").write.parquet(path)
    day = temporal.scans_between(spark.read.parquet(path), dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert day.count() == 2
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(scan_datetime,2024-01-02 00:00:00)" in plan


def test_net_sale(spark):
    price = F.lit(Decimal("999999.99"))
    assert one(spark, money.net_sale(F.lit(2), price)) == Decimal("1999999.98")
    assert one(spark, money.net_sale(F.lit(2_000_000), price)) is None
    assert one(spark, money.net_sale(F.lit(None).cast("int"), price)) is None


def test_price_drift_range(spark):
    price = F.lit(Decimal("10.00")).cast("decimal(10,2)")
    for draw, expected in (("0", "9.00"), ("0.5", "10.00"), ("0.999", "11.00")):
        assert one(spark, money.drifted_price(price, F.lit(Decimal(draw)))) == Decimal(expected)


@pytest.mark.parametrize("hour,scans", [
    (0, 0), (9, 0), (10, 16), (11, 133), (12, 133), (13, 33), (15, 33), (16, 100), (18, 100), (19, 22), (21, 22), (22, 0),
])
def test_scans_per_minute(spark, hour, scans):
    ts = F.lit(f"2024-01-01 {hour:02d}:30:00").cast("timestamp_ntz")
    assert one(spark, traffic.scans_per_minute(ts)) == scans


def test_zone_factor(spark):
    ts = F.lit("2024-01-01 11:00:00").cast("timestamp_ntz")
    expected = {"HST (GMT-10)": 53, "AKST (GMT-09)": 53, "MST (GMT-07)": 106, "PST (GMT-08)": 133}
    for zone, scans in expected.items():
        assert one(spark, traffic.expected_scans(ts, F.lit(zone))) == scans


def test_scan_ids_are_distinct(spark):
    assert spark.range(20_000).select(draws.new_scan_id().alias("id")).distinct().count() == 20_000
    repeated = spark.range(10).select(draws.new_scan_id(5).alias("id"))
    assert repeated.collect() == repeated.collect()


GOOD = '{"scan_id":"a","store_id":123,"scan_datetime":"2025-04-04 15:48:44","item_upc":"012345678905","unit_qty":2,"unit_price":19.99}'


@pytest.mark.parametrize("line,problem", [
    (GOOD, None),
    (GOOD[:-4], "malformed"),
    ("", "malformed"),
    ("no json", "malformed"),
    (None, "malformed"),
    (GOOD.replace('"unit_qty":2,', ""), "missing unit_qty"),
    (GOOD.replace('"store_id":123', '"store_id":null'), "missing store_id"),
    (GOOD.replace('"store_id":123', '"store_id":"x"'), "malformed"),
    (GOOD.replace("19.99", "12345678.99"), "malformed"),
    (GOOD.replace('"unit_qty":2', '"unit_qty":-1'), "negative quantity"),
    (GOOD.replace("{", '{"extra":1,'), None),
])
def test_contract(spark, line, problem):
    lines = spark.createDataFrame([(line,)], "value string")
    assert records.check_contract(lines).first()["problem"] == problem


def test_record_round_trip(spark):
    lines = spark.createDataFrame([(GOOD,)], "value string")
    good, rejected = records.split_by_contract(lines)
    assert rejected.count() == 0
    assert good.select(records.scan_json(good).alias("v")).first()["v"] == GOOD
