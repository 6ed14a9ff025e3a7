"""Silver models, dashboard figures and inventory on the test tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.temporal import scan_date
from tillhouse.operators.promotions import SCOPE, best_prices, draft_promotions
from tillhouse.plans import dashboard, inventory, silver
from tillhouse.registry.core import query
from tillhouse.session import new_folder, staged
from tillhouse.sources import retail_views as rv
from tillhouse.sources.readers import read_table
from tillhouse.sources.writers import overwrite_partitions, overwrite_table, write_partitioned, upsert_table

TODAY = dt.date(2024, 1, 30)
DAY_AFTER = dt.date(2024, 1, 31)
FIXED_DAY = dt.date(2024, 1, 15)
AS_OF = dt.datetime(2024, 2, 1)
LATER = dt.datetime(2024, 2, 2)


def dimension(spark: SparkSession, sf: str) -> DataFrame:
    return silver.items_categories(rv.items(spark, sf), rv.categories(spark, sf), rv.MADE_UP_FROM)


def stored_dimensions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stores and item dimension as tables of their own, as silver keeps them: the planner knows their size beforehand.

    The size of a join is not known before it runs; by then the sales would be shuffled to meet it.
    """
    return staged(rv.stores(spark, sf), "stores"), staged(dimension(spark, sf), "items_categories")


def detail(spark: SparkSession, sf: str) -> DataFrame:
    return silver.sales_detail(rv.scans(spark, sf), *stored_dimensions(spark, sf))


def timed_detail(spark: SparkSession, sf: str, voided: bool = True, run_date: dt.date | None = None) -> DataFrame:
    return silver.sales_detail(rv.timed_scans(spark, sf, voided), *stored_dimensions(spark, sf), run_date)


@query(
    "category_code bigint, category_name text, net_units bigint, net_sales double",
    """SELECT category_code, category_name, sum(unit_qty) AS net_units, sum(unit_qty * unit_price) AS net_sales
       FROM scans JOIN stores USING (store_id) JOIN items ON item_upc = upc_code JOIN categories USING (category_code)
       GROUP BY ALL ORDER BY net_sales DESC, category_code LIMIT 10""",
    ["scans", "stores", "items", "categories"],
)
def top10_categories(spark, sf):
    return dashboard.top_categories(
        rv.scans(spark, sf), rv.stores(spark, sf), rv.items(spark, sf), rv.categories(spark, sf)
    )


@query(
    "category_code bigint, category_name text, net_units bigint, net_sales double",
    """SELECT category_code, category_name, sum(unit_qty) AS net_units, sum(net_sale) AS net_sales
       FROM detail GROUP BY ALL ORDER BY net_sales DESC, category_code LIMIT 10""",
    ["detail"],
)
def top10_from_daily_rollup(spark, sf):
    return dashboard.top_categories_from_rollup(silver.sales_by_day(detail(spark, sf)))


@query(
    "year_month text, item_upc text, state text, region text, category_code bigint, category_name text, "
    "net_units bigint, net_sales double",
    """SELECT CAST(date_trunc('month', scan_ts) AS TIMESTAMP) AS year_month, item_upc, state, timezone AS region,
              category_code, category_name, sum(unit_qty) AS net_units, sum(unit_qty * unit_price) AS net_sales
       FROM scans JOIN stores USING (store_id) JOIN items ON item_upc = upc_code JOIN categories USING (category_code)
       GROUP BY ALL""",
    ["scans", "stores", "items", "categories"],
)
def monthly_detail(spark, sf):
    return dashboard.monthly_detail(
        rv.scans(spark, sf), rv.stores(spark, sf), rv.items(spark, sf), rv.categories(spark, sf)
    )


_DIMENSION = "item_id bigint, item_upc text, base_price double, category_code bigint, category_name text"


@query(_DIMENSION, "SELECT * FROM dimension", ["dimension"])
def items_categories(spark, sf):
    return dimension(spark, sf)


@query(_DIMENSION, "SELECT * FROM dimension", ["dimension"])
def items_categories_overwrite(spark, sf):
    """Two runs: the second replaces the whole table of the first."""
    path = new_folder(spark, "items_categories")
    overwrite_table(dimension(spark, sf).withColumn("base_price", F.lit(None).cast("decimal(10,2)")), path)
    overwrite_table(dimension(spark, sf), path)
    return read_table(spark, path)


_DETAIL = (
    "scan_id text, store_id bigint, scan_timestamp text, scan_datestamp text, item_upc text, unit_qty bigint, "
    "unit_price double, net_sale double, item_id bigint, category_code bigint, category_name text, city text, "
    "state text, region text"
)


@query(_DETAIL, "SELECT * FROM detail", ["detail"])
def sales_detail(spark, sf):
    return detail(spark, sf)


@query(
    _DETAIL,
    """SELECT * REPLACE (CASE WHEN scan_datestamp = DATE '2024-01-15' THEN unit_qty ELSE 1 END AS unit_qty,
              CASE WHEN scan_datestamp = DATE '2024-01-15' THEN net_sale
                   ELSE CAST(unit_price AS DECIMAL(10,2)) END AS net_sale)
       FROM timed_detail""",
    ["timed_detail"],
)
def sales_detail_incremental(spark, sf):
    """Full build before any void, then one day is run again with its voids."""
    path = new_folder(spark, "sales_detail")
    write_partitioned(timed_detail(spark, sf, voided=False), path, ["scan_datestamp"])
    upsert_table(
        spark, path, timed_detail(spark, sf, run_date=FIXED_DAY), ["scan_id"], [-F.col("unit_qty")],
        ["scan_datestamp"], partition_fixed_by_key=True, incoming_wins=True,
    )
    return read_table(spark, path)


_BY_DAY = (
    "scan_date text, category_code bigint, category_name text, region text, net_units bigint, net_sales double"
)


@query(
    _BY_DAY,
    """SELECT CAST(scan_timestamp AS DATE) AS scan_date, category_code, category_name, region,
              sum(unit_qty) AS net_units, sum(net_sale) AS net_sales FROM detail GROUP BY ALL""",
    ["detail"],
)
def sales_by_day(spark, sf):
    return silver.sales_by_day(detail(spark, sf))


@query(
    _BY_DAY,
    """SELECT CAST(scan_timestamp AS DATE) AS scan_date, category_code, category_name, region,
              sum(CASE WHEN scan_datestamp = DATE '2024-01-15' THEN unit_qty ELSE 1 END) AS net_units,
              sum(CASE WHEN scan_datestamp = DATE '2024-01-15' THEN net_sale
                       ELSE CAST(unit_price AS DECIMAL(10,2)) END) AS net_sales
       FROM timed_detail GROUP BY ALL""",
    ["timed_detail"],
)
def sales_by_day_partition_overwrite(spark, sf):
    """All days before any void, then one whole day replaced; other partitions stay."""
    path = new_folder(spark, "sales_by_day")
    write_partitioned(silver.sales_by_day(timed_detail(spark, sf, voided=False)), path, ["scan_date"])
    overwrite_partitions(silver.sales_by_day(timed_detail(spark, sf, run_date=FIXED_DAY)), path, ["scan_date"])
    return read_table(spark, path)


@query(
    "year bigint, month bigint, item_upc text, category_code bigint, category_name text, store_id bigint, "
    "city text, state text, region text, net_units bigint, net_sales double",
    """SELECT year(scan_timestamp) AS year, month(scan_timestamp) AS month, item_upc, category_code, category_name,
              store_id, city, state, region, sum(unit_qty) AS net_units, sum(net_sale) AS net_sales
       FROM detail GROUP BY ALL""",
    ["detail"],
)
def sales_by_month(spark, sf):
    return silver.sales_by_month(detail(spark, sf))


@query(
    "net_sales double, trx bigint",
    """SELECT sum(net_sale) AS net_sales, count(*) AS trx FROM timed_scans
       WHERE unit_qty <> 0 AND CAST(scan_ts AS DATE) >= DATE '2024-01-30'""",
    ["timed_scans"],
)
def sales_today(spark, sf):
    return dashboard.sales_today(rv.timed_scans(spark, sf), TODAY)


@query(
    "scan_date text, total_net_sales double, trx bigint",
    """SELECT CAST(scan_ts AS DATE) AS scan_date, sum(net_sale) AS total_net_sales, count(*) AS trx
       FROM timed_scans WHERE unit_qty <> 0 AND scan_ts >= DATE '2024-01-24' AND scan_ts < DATE '2024-01-31'
       GROUP BY ALL""",
    ["timed_scans"],
)
def daily_totals(spark, sf):
    return dashboard.daily_totals(rv.timed_scans(spark, sf), dt.date(2024, 1, 24), DAY_AFTER)


@query(
    "avg_net_sales double, avg_trx double",
    """SELECT round(avg(total), 2) AS avg_net_sales, avg(trx) AS avg_trx FROM (
           SELECT CAST(scan_ts AS DATE) AS scan_date, sum(net_sale) AS total, count(*) AS trx FROM timed_scans
           WHERE unit_qty <> 0 AND scan_ts >= DATE '2024-01-24' AND scan_ts < DATE '2024-01-31' GROUP BY ALL)""",
    ["timed_scans"],
)
def sales_avg_7day(spark, sf):
    return dashboard.average_day(rv.timed_scans(spark, sf), DAY_AFTER)


_INVENTORY = (
    "delta_date text, store_id bigint, item_upc text, net_quantity_delta bigint, last_updated text"
)


@query(
    _INVENTORY,
    """SELECT CAST(scan_ts AS DATE) AS delta_date, store_id, item_upc, sum(unit_qty) AS net_quantity_delta,
              '2024-02-01 00:00:00' AS last_updated
       FROM timed_scans WHERE scan_ts >= DATE '2024-01-01' AND scan_ts < DATE '2024-01-31'
       GROUP BY ALL""",
    ["timed_scans"],
)
def inventory_delta(spark, sf):
    return inventory.inventory_delta(rv.timed_scans(spark, sf), DAY_AFTER, lookback_days=30, as_of=AS_OF)


@query(
    _INVENTORY,
    """SELECT CAST(scan_ts AS DATE) AS delta_date, store_id, item_upc,
              sum(CASE WHEN scan_ts >= DATE '2024-01-28' THEN unit_qty ELSE 1 END) AS net_quantity_delta,
              CASE WHEN CAST(scan_ts AS DATE) >= DATE '2024-01-28' THEN '2024-02-02 00:00:00'
                   ELSE '2024-02-01 00:00:00' END AS last_updated
       FROM timed_scans GROUP BY ALL""",
    ["timed_scans"],
)
def inventory_delta_upsert(spark, sf):
    """All days before any void, then the last three days run again."""
    path = new_folder(spark, "inventory_delta")
    before = inventory.inventory_delta(rv.timed_scans(spark, sf, voided=False), DAY_AFTER, 30, AS_OF)
    inventory.write_inventory_delta(spark, before, path, create=True)
    again = inventory.inventory_delta(rv.timed_scans(spark, sf), DAY_AFTER, 3, LATER)
    inventory.write_inventory_delta(spark, again, path)
    return read_table(spark, path)


def promotions(spark: SparkSession, sf: str) -> DataFrame:
    """Promotions drafted for all categories, regions and clearance items, and one for everything."""
    scaled = (F.col("category_code") - 20000).cast("double")
    drafts = draft_promotions(
        rv.categories(spark, sf), dt.date(1997, 6, 1),
        scaled % 40 / 40, scaled % 70 / 70, scaled % 90 / 90,
    )
    nothing = {c: F.lit(None).cast(drafts.schema[c].dataType) for c in ("region", "category_code", "item_id")}

    def offer(rows: DataFrame, start: str, end: str, kind: str, value, **scope) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("promotion_name"), F.lit(start).cast("date").alias("start_date"),
            F.lit(end).cast("date").alias("end_date"), F.lit(kind).alias("discount_type"),
            F.lit(value).cast("decimal(10,2)").alias("discount_value"),
            *[scope.get(c, empty).alias(c) for c, empty in nothing.items()],
            F.lit(0).alias("conversions"),
        )

    regions, part = rv.table(spark, sf, "region"), rv.table(spark, sf, "part")
    clearance = part.where("p_size = 45")
    return (
        drafts
        .unionByName(offer(regions, "1998-01-10", "1998-01-20", "AMT_OFF", Decimal("12.50"), region=F.col("r_name")))
        .unionByName(offer(clearance, "1999-03-01", "1999-03-31", "NEW_PRICE", Decimal("99.99"), item_id=F.col("p_partkey")))
        .unionByName(offer(clearance, "1999-03-15", "1999-04-15", "AMT_OFF", Decimal("20000"),
                           item_id=F.col("p_partkey"), category_code=rv.category_code()))
        .unionByName(offer(regions.agg(F.min("r_name")), "1999-03-20", "1999-04-02", "PCT_OFF", Decimal("7.25")))
    )


_PROMOTIONS = """
    SELECT 'Save on ' || category_name AS promotion_name, DATE '1997-06-01' AS start_date,
           DATE '1997-06-01' + CAST(floor((CAST(category_code - 20000 AS DOUBLE) % 90 / 90) * 20) + 5 AS INT) AS end_date,
           (['PCT_OFF', 'AMT_OFF', 'NEW_PRICE', 'BOGO'])
               [CAST(floor((CAST(category_code - 20000 AS DOUBLE) % 40 / 40) * 4) + 1 AS INT)] AS discount_type,
           CAST(floor(power(CAST(category_code - 20000 AS DOUBLE) % 70 / 70, 3) * 5 + 5) AS DECIMAL(10,2)) AS discount_value,
           CAST(NULL AS VARCHAR) AS region, category_code, CAST(NULL AS BIGINT) AS item_id
    FROM categories"""


@query(
    "promotion_name text, start_date text, end_date text, discount_type text, discount_value double, "
    "category_code bigint",
    f"SELECT * FROM ({_PROMOTIONS})",
    ["categories"],
)
def promotion_drafts(spark, sf):
    return promotions(spark, sf).where(F.col("promotion_name").startswith("Save on "))


@query(
    "scan_id text, best_price double",
    f"""SELECT d.scan_id, round(greatest(least(
            any_value(CAST(d.unit_price AS DECIMAL(18,6))),
            min(CASE p.discount_type
                WHEN 'PCT_OFF' THEN CAST(d.unit_price * ((100.00 - p.discount_value) * 0.01) AS DECIMAL(18,6))
                WHEN 'AMT_OFF' THEN CAST(d.unit_price - p.discount_value AS DECIMAL(18,6))
                WHEN 'NEW_PRICE' THEN CAST(p.discount_value AS DECIMAL(18,6)) END)),
            CAST(0 AS DECIMAL(18,6))), 2) AS best_price
        FROM detail d LEFT JOIN (
            {_PROMOTIONS}
            UNION ALL SELECT 'AMT_OFF', DATE '1998-01-10', DATE '1998-01-20', 'AMT_OFF', 12.50, r_name, NULL, NULL FROM region
            UNION ALL SELECT 'NEW_PRICE', DATE '1999-03-01', DATE '1999-03-31', 'NEW_PRICE', 99.99, NULL, NULL, p_partkey
                      FROM part WHERE p_size = 45
            UNION ALL SELECT 'AMT_OFF', DATE '1999-03-15', DATE '1999-04-15', 'AMT_OFF', 20000, NULL,
                      20000 + 10 * CAST(substr(p_brand, 7) AS BIGINT), p_partkey FROM part WHERE p_size = 45
            UNION ALL SELECT 'PCT_OFF', DATE '1999-03-20', DATE '1999-04-02', 'PCT_OFF', 7.25, NULL, NULL, NULL
        ) p ON d.scan_datestamp BETWEEN p.start_date AND p.end_date
           AND (p.region IS NULL OR p.region = d.region)
           AND (p.category_code IS NULL OR p.category_code = d.category_code)
           AND (p.item_id IS NULL OR p.item_id = d.item_id)
        GROUP BY d.scan_id""",
    ["categories", "detail"],
)
def promotion_best_price(spark, sf):
    """Sales are matched where they are stored, dealt by day."""
    used = detail(spark, sf).select("scan_id", "scan_timestamp", "scan_datestamp", "unit_price", *SCOPE)
    stored = staged(used.repartition("scan_datestamp"), "sales_detail")
    sales = stored.withColumn("sale_date", scan_date(F.col("scan_timestamp")))
    return best_prices(sales, promotions(spark, sf))
