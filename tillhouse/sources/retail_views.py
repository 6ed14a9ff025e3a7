"""The driver's test tables presented as the retail model.

Every view is a projection, or a join with the constant-size nation and region
tables, of one whole test table.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Made-up items start here in the test data, above any part key, so that the
# catalogue filter keeps every part at any scale (production: 50000).
MADE_UP_FROM = 1_000_000_000_000
MADE_UP_SIZE = 45


@cache
def _schema(path: str) -> T.StructType:
    """Schema of a test table; the tables are read-only, so it is inferred once."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def category_code() -> Column:
    return 20000 + 10 * F.substring(F.col("p_brand"), 7, 10).cast("bigint")


def upc(key: Column) -> Column:
    return F.lpad(key.cast("string"), 11, "0")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        category_code().alias("category_code"), F.col("p_brand").alias("category_name")
    ).distinct()


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        category_code().alias("category_code"),
        F.when(F.col("p_size") > MADE_UP_SIZE, key + MADE_UP_FROM).otherwise(key).alias("item_id"),
        F.col("p_retailprice").try_cast("decimal(10,2)").alias("base_price"),
        upc(key).alias("upc_code"),
        F.col("p_size").alias("case_qty"),
        F.col("p_size").alias("_frequency"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = F.col("r_name")
    zone = (
        F.when(region == "AFRICA", "EST (GMT-05)").when(region == "AMERICA", "CST (GMT-06)")
        .when(region == "ASIA", "MST (GMT-07)").when(region == "EUROPE", "PST (GMT-08)")
        .otherwise("HST (GMT-10)")
    )
    supplier, nation, regions = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    # nation and region have a fixed number of rows.
    placed = supplier.join(
        F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")
    ).join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey"))
    return placed.select(
        F.col("s_suppkey").alias("store_id"),
        F.col("n_name").alias("city"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("state"),
        region.alias("region"),
        zone.alias("timezone"),
    )


def scans(spark: SparkSession, sf_dir: str, voided: bool = True) -> DataFrame:
    """Line items as scans; returned ones count as voids unless ``voided`` is off."""
    day = F.col("l_shipdate").cast("date").cast("string")
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], day).alias("scan_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("version_key"),
        F.col("l_suppkey").alias("store_id"),
        F.concat(day, F.lit(" 00:00:00")).alias("scan_datetime"),
        upc(F.col("l_partkey")).alias("item_upc"),
        (F.when(F.col("l_returnflag") == "R", 0).otherwise(quantity) if voided else quantity).alias("unit_qty"),
        F.col("l_extendedprice").try_cast("decimal(8,2)").alias("unit_price"),
    )


def timezone_of(store: Column) -> Column:
    zones = ["EST (GMT-05)", "CST (GMT-06)", "MST (GMT-07)", "PST (GMT-08)", "AKST (GMT-09)", "HST (GMT-10)"]
    return F.element_at(F.array(*[F.lit(z) for z in zones]), (store % 6).cast("int") + 1)


def timed_scans(spark: SparkSession, sf_dir: str, voided: bool = True) -> DataFrame:
    """Events as scans with a time of day; errors count as voids."""
    quantity = F.when(F.col("event_type") == "error", 0).otherwise(1) if voided else F.lit(1)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("scan_id"),
        F.col("user_id").alias("store_id"),
        F.col("ts").alias("scan_ts"),
        upc(F.get_json_object("props", "$.k")).alias("item_upc"),
        quantity.alias("unit_qty"),
        F.col("value").try_cast("decimal(8,2)").alias("unit_price"),
        timezone_of(F.col("user_id")).alias("timezone"),
    )


def item_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed over all items, chosen by type.

    Every item gets a new price; PROMO items are deleted after that, SMALL ones
    are deleted and inserted again, and each LARGE one gets a new sibling. One
    pass over the table: each row is expanded into its changes.
    """
    key, kind = F.col("p_partkey"), F.col("p_type")
    item = F.when(F.col("p_size") > MADE_UP_SIZE, key + MADE_UP_FROM).otherwise(key)
    price = F.col("p_retailprice").try_cast("decimal(10,2)")

    def change(item_id: Column, op: str, new_price: Column, seq: int) -> Column:
        return F.struct(
            item_id.alias("item_id"), F.lit(op).alias("op"),
            new_price.cast("decimal(10,2)").alias("base_price"), F.lit(seq).alias("seq"),
        )

    raised = price * F.lit(Decimal("1.05"))
    one = F.lit(Decimal("1.00"))
    changes = F.array(
        change(item, "U", raised, 1),
        F.when(kind.isin("PROMO", "SMALL"), change(item, "D", raised, 2)),
        F.when(kind == "SMALL", change(item, "I", one, 3)),
        F.when(kind == "LARGE", change(key + 2 * MADE_UP_FROM, "I", one, 1)),
    )
    return (
        table(spark, sf_dir, "part").select(F.explode(F.array_compact(changes)).alias("_change"))
        .select("_change.*")
    )
