"""Silver models: item dimension, enriched sales, daily and monthly rollups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.money import cents, net_sale, total
from tillhouse.functions.temporal import scan_date, scans_between, with_scan_time
from tillhouse.operators.dimensions import join_dimension
from tillhouse.operators.versions import current_scans
from tillhouse.schemas import SYNTHETIC_ITEM_FLOOR
from tillhouse.sources.paths import table_exists
from tillhouse.sources.readers import read_table
from tillhouse.sources.writers import (
    overwrite_partitions, overwrite_table, upsert_table,
)

DETAIL_COLUMNS = [
    "scan_id", "store_id", "scan_timestamp", "scan_datestamp", "item_upc", "unit_qty",
    "unit_price", "net_sale", "item_id", "category_code", "category_name", "city", "state", "region",
]


def items_categories(
    items: DataFrame, categories: DataFrame, catalog_limit: int = SYNTHETIC_ITEM_FLOOR
) -> DataFrame:
    """Catalogue items with their category; ids from ``catalog_limit`` on are made up."""
    catalogue = items.where(F.col("item_id") < catalog_limit).select(
        "category_code", "item_id", F.col("upc_code").alias("item_upc"), "base_price"
    )
    names = categories.select("category_code", "category_name")
    return join_dimension(catalogue, names, "category_code").select(
        "item_id", "item_upc", "base_price", "category_code", "category_name"
    )


def sales_detail(
    scans: DataFrame,
    stores: DataFrame,
    item_dimension: DataFrame,
    run_date: dt.date | None = None,
) -> DataFrame:
    """Scans with store place and item category.

    With ``run_date`` only the scans of that day are read (the incremental run).
    """
    day = scans if run_date is None else scans_between(
        scans, run_date, run_date + dt.timedelta(days=1)
    )
    # Only what isn't derived is shuffled, and the places, which the planner mostly broadcasts, come last.
    facts = with_scan_time(day).select("scan_id", "store_id", "scan_ts", "item_upc", "unit_qty", "unit_price")
    places = stores.select("store_id", "city", "state", "region")
    names = item_dimension.select("item_upc", "item_id", "category_code", "category_name")
    enriched = join_dimension(join_dimension(facts, names, "item_upc"), places, "store_id")
    return enriched.withColumns({
        "scan_timestamp": F.col("scan_ts"),
        "scan_datestamp": scan_date(F.col("scan_ts")),
        "net_sale": net_sale(F.col("unit_qty"), F.col("unit_price")),
    }).select(*DETAIL_COLUMNS)


def sales_by_day(detail: DataFrame) -> DataFrame:
    """Units and sales by day, category and region; voids add nothing."""
    return detail.groupBy(
        scan_date(F.col("scan_timestamp")).alias("scan_date"),
        "category_code", "category_name", "region",
    ).agg(F.sum("unit_qty").alias("net_units"), total(cents(F.col("net_sale"))).alias("net_sales"))


def sales_by_month(detail: DataFrame) -> DataFrame:
    """Units and sales by month, item and store."""
    return detail.groupBy(
        F.year("scan_timestamp").alias("year"),
        F.month("scan_timestamp").alias("month"),
        "item_upc", "category_code", "category_name", "store_id", "city", "state", "region",
    ).agg(F.sum("unit_qty").alias("net_units"), total(cents(F.col("net_sale"))).alias("net_sales"))


def build_silver(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    silver_path: str,
    run_date: dt.date | None = None,
    catalog_limit: int = SYNTHETIC_ITEM_FLOOR,
) -> dict[str, str]:
    """Build the silver tables in dependency order and return their paths.

    Without ``run_date``, or as long as a table is absent, everything is built
    anew. With it, the scans of that day are merged into ``sales_detail``, the
    day's partition of ``sales_by_day`` and the month's of ``sales_by_month``
    are replaced, and the item dimension is overwritten. ``bronze`` holds
    ``scans``, ``stores``, ``item_master``, ``item_categories``; of its scans,
    which may hold all versions, the latest of each counts.
    """
    paths = {
        name: f"{silver_path}/{name}"
        for name in ("items_categories", "sales_detail", "sales_by_day", "sales_by_month")
    }
    if not all(table_exists(spark, path) for path in paths.values()):
        run_date = None
    overwrite_table(
        items_categories(bronze["item_master"], bronze["item_categories"], catalog_limit),
        paths["items_categories"],
    )
    dimension = read_table(spark, paths["items_categories"])
    scans = bronze["scans"]
    if run_date is not None:
        scans = scans_between(scans, run_date, run_date + dt.timedelta(days=1))
    detail = sales_detail(current_scans(scans), bronze["stores"], dimension)
    if run_date is None:
        overwrite_table(detail, paths["sales_detail"], ["scan_datestamp"])
    else:
        # A void repeats the time of its sale, so a scan keeps its partition.
        upsert_table(
            spark, paths["sales_detail"], detail, ["scan_id"],
            [F.col("scan_timestamp"), -F.col("unit_qty")], ["scan_datestamp"],
            partition_fixed_by_key=True, incoming_wins=True,
        )
    sales = read_table(spark, paths["sales_detail"])
    if run_date is None:
        overwrite_table(sales_by_day(sales), paths["sales_by_day"], ["scan_date"])
        overwrite_table(sales_by_month(sales), paths["sales_by_month"], ["year", "month"])
    else:
        # Only whole days are replaced, never part of one.
        whole_day = sales.where(F.col("scan_datestamp") == F.lit(run_date))
        overwrite_partitions(sales_by_day(whole_day), paths["sales_by_day"], ["scan_date"])
        first = run_date.replace(day=1)
        day = F.col("scan_datestamp")
        month = sales.where((day >= F.lit(first)) & (day < F.add_months(F.lit(first), 1)))
        overwrite_partitions(sales_by_month(month), paths["sales_by_month"], ["year", "month"])
    return paths
