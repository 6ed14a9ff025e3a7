"""Dashboard figures. "Today" is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.money import cents, gross_cents, net_sale, total
from tillhouse.functions.temporal import month_start, scan_date, scans_between, with_scan_time
from tillhouse.operators.dimensions import join_dimension

WINDOW_DAYS = 7


def _live_sales(scans: DataFrame, first: dt.date, until: dt.date | None) -> DataFrame:
    live = scans_between(scans, first, until).where(F.col("unit_qty") != 0)
    return live.select(
        scan_date(F.col("scan_ts")).alias("scan_date"),
        net_sale(F.col("unit_qty"), F.col("unit_price")).alias("net_sale"),
    )


def sales_today(scans: DataFrame, today: dt.date) -> DataFrame:
    """Sales and number of scans from ``today`` on; one row, also without scans."""
    return _live_sales(scans, today, None).agg(
        total(cents(F.col("net_sale"))).alias("net_sales"), F.count(F.lit(1)).alias("trx")
    )


def daily_totals(scans: DataFrame, first: dt.date, until: dt.date) -> DataFrame:
    return _live_sales(scans, first, until).groupBy("scan_date").agg(
        total(cents(F.col("net_sale"))).alias("total_net_sales"), F.count(F.lit(1)).alias("trx")
    )


def average_day(scans: DataFrame, today: dt.date, days: int = WINDOW_DAYS) -> DataFrame:
    """Mean of the daily totals of the days before ``today``; days without scans do not count."""
    totals = daily_totals(scans, today - dt.timedelta(days=days), today)
    return totals.agg(
        F.round(F.avg("total_net_sales"), 2).alias("avg_net_sales"),
        F.avg("trx").alias("avg_trx"),
    )


def _star(scans: DataFrame, stores: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    """Scans with their month, joined with all three dimensions one after the other.

    Nothing is counted or hinted: the planner broadcasts a dimension that its statistics, or its measured size at run time,
    prove small, and shuffles otherwise, where adaptive execution splits a hot store or item.
    """
    monthly = with_scan_time(scans).select(
        month_start(F.col("scan_ts")).alias("year_month"),
        "store_id", "item_upc",
        F.col("unit_qty").alias("net_units"),
        gross_cents(F.col("unit_qty"), F.col("unit_price")).alias("_cents"),
    )
    places = stores.select("store_id", "state", F.col("timezone").alias("region"))
    master = items.select(F.col("upc_code").alias("item_upc"), "category_code")
    names = categories.select("category_code", "category_name")
    joined = monthly
    for dimension, key in ((places, "store_id"), (master, "item_upc"), (names, "category_code")):
        joined = join_dimension(joined, dimension, key)
    return joined


def monthly_detail(scans: DataFrame, stores: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    """Units and sales by month, item, state, zone and category."""
    return _star(scans, stores, items, categories).groupBy(
        "year_month", "item_upc", "state", "region", "category_code", "category_name"
    ).agg(F.sum("net_units").alias("net_units"), total(F.col("_cents")).alias("net_sales"))


def category_totals(rows: DataFrame, net_sales: Column | None = None) -> DataFrame:
    """Units and sales per category of a rollup, or of rows with another sales sum."""
    sales = F.sum("net_sales") if net_sales is None else net_sales
    return rows.groupBy("category_code", "category_name").agg(
        F.sum("net_units").alias("net_units"), sales.alias("net_sales")
    )


def top_rows(df: DataFrame, measure: str, tie: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), F.col(tie).asc()).limit(n)


def top_categories(
    scans: DataFrame, stores: DataFrame, items: DataFrame, categories: DataFrame, n: int = 10
) -> DataFrame:
    """Categories with the greatest sales, straight from bronze.

    Sums of monthly sums equal sums of the joined rows, so the rows go to the
    category level in one aggregation.
    """
    rows = _star(scans, stores, items, categories)
    return top_rows(category_totals(rows, total(F.col("_cents"))), "net_sales", "category_code", n)


def top_categories_from_rollup(rollup: DataFrame, n: int = 10) -> DataFrame:
    """The same from ``sales_by_day`` or ``sales_by_month`` (catalogue items only)."""
    return top_rows(category_totals(rollup), "net_sales", "category_code", n)
