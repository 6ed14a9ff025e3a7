"""Declared schemas of the retail tables and messages."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

ITEM_CATEGORIES = T.StructType([
    T.StructField("category_code", T.IntegerType(), False),
    T.StructField("category_name", T.StringType()),
    T.StructField("category_description", T.StringType()),
    T.StructField("_avg_price", T.DecimalType(18, 4)),
    T.StructField("_frequency", T.DecimalType(18, 4)),
])

ITEM_MASTER = T.StructType([
    T.StructField("category_code", T.IntegerType()),
    T.StructField("item_id", T.IntegerType(), False),
    T.StructField("base_price", T.DecimalType(10, 2)),
    T.StructField("upc_code", T.StringType()),
    T.StructField("case_qty", T.IntegerType()),
    T.StructField("_frequency", T.IntegerType()),
])

STORES = T.StructType([
    T.StructField("store_id", T.IntegerType(), False),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zipcode", T.StringType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("region", T.StringType()),
    T.StructField("timezone", T.StringType()),
])

# One scan as it arrives; the time is the store's wall clock as text.
RETAIL_SCANS = T.StructType([
    T.StructField("scan_id", T.StringType()),
    T.StructField("store_id", T.IntegerType()),
    T.StructField("scan_datetime", T.StringType()),
    T.StructField("item_upc", T.StringType()),
    T.StructField("unit_qty", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(8, 2)),
])

PROMOTIONS = T.StructType([
    T.StructField("promotion_id", T.LongType(), False),
    T.StructField("promotion_name", T.StringType()),
    T.StructField("start_date", T.DateType(), False),
    T.StructField("end_date", T.DateType(), False),
    T.StructField("discount_type", T.StringType(), False),
    T.StructField("discount_value", T.DecimalType(10, 2), False),
    T.StructField("region", T.StringType()),
    T.StructField("category_code", T.IntegerType()),
    T.StructField("item_id", T.IntegerType()),
    T.StructField("conversions", T.IntegerType()),
])

INVENTORY_DELTA = T.StructType([
    T.StructField("delta_date", T.DateType()),
    T.StructField("store_id", T.IntegerType()),
    T.StructField("item_upc", T.StringType()),
    T.StructField("net_quantity_delta", T.IntegerType()),
    T.StructField("last_updated", T.TimestampType()),
])

# start, stop and scans messages share one wide row; ``type`` tells them apart.
ACTIVITY_MESSAGE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("localTime", T.StringType()),
    T.StructField("storeCount", T.LongType()),
    T.StructField("batchCount", T.LongType()),
    T.StructField("voidCount", T.LongType()),
    T.StructField("dataVolume", T.LongType()),
])

TABLES = {
    "item_categories": ITEM_CATEGORIES,
    "item_master": ITEM_MASTER,
    "stores": STORES,
    "scans": RETAIL_SCANS,
    "promotions": PROMOTIONS,
    "inventory_delta": INVENTORY_DELTA,
}

# Fixed values that results depend on.
SYNTHETIC_ITEM_FLOOR = 50000
MESSAGE_TYPES = ("start", "stop", "scans")
METADATA_COLUMNS = (
    "_hoodie_commit_time",
    "_hoodie_commit_seqno",
    "_hoodie_record_key",
    "_hoodie_partition_path",
    "_hoodie_file_name",
)


def create_tables(spark: SparkSession, database: str, names: list[str] | None = None) -> None:
    """Create the declared tables, empty, in a catalog database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in names or list(TABLES):
        spark.catalog.createTable(f"{database}.{name}", source="parquet", schema=TABLES[name])
