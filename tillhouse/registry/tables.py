"""Table operators: snapshots, change feeds, item changes, checks, records."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.records import check_contract, scan_json as scan_record
from tillhouse.functions.temporal import is_due
from tillhouse.operators import items as item_ops
from tillhouse.operators.quality import duplicate_keys, orphan_keys
from tillhouse.operators.versions import apply_changes as apply_feed, latest_per_key, publish_views, read_snapshot
from tillhouse.registry.core import query
from tillhouse.session import new_folder
from tillhouse.sources import retail_views as rv
from tillhouse.sources.readers import drop_metadata, read_base, read_table
from tillhouse.sources.writers import append_rows, overwrite_table, upsert_table

NOW = dt.datetime(2024, 1, 15, 12, 0, 0)
VERSION_ORDER = ("scan_datetime", "item_upc", "store_id")


def _with_status(spark: SparkSession, sf: str) -> DataFrame:
    """Scans with the line status, which tells base rows (O) from later ones (F)."""
    line = rv.table(spark, sf, "lineitem")
    status = F.col("l_linestatus")
    day = F.col("l_shipdate").cast("date").cast("string")
    return line.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("version_key"),
        F.col("l_suppkey").alias("store_id"),
        F.concat(day, F.lit(" 00:00:00")).alias("scan_datetime"),
        rv.upc(F.col("l_partkey")).alias("item_upc"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_quantity").cast("int")).alias("unit_qty"),
        status.alias("status"),
    )


_VERSION = "version_key text, store_id bigint, scan_datetime text, item_upc text, unit_qty bigint"
_LATEST = """SELECT * FROM scans QUALIFY row_number() OVER (
    PARTITION BY version_key ORDER BY scan_datetime DESC, item_upc DESC, store_id DESC) = 1"""


@query(_VERSION, _LATEST, ["scans"])
def snapshot_read(spark, sf):
    rows = _with_status(spark, sf)
    base, log = rows.where("status = 'O'"), rows.where("status <> 'O'")
    return read_snapshot(base, log, ["version_key"], [F.col(c) for c in VERSION_ORDER])


@query("scan_id text, unit_qty bigint, unit_price double", "SELECT scan_id, unit_qty, unit_price FROM scans", ["scans"])
def snapshot_read_unique_base(spark, sf):
    """Sales in the base, voids in the log: the base is merged without a shuffle while the log is small."""
    columns = ("scan_id", "unit_qty", "unit_price")
    base = rv.scans(spark, sf, voided=False).select(*columns, F.lit(0).alias("version"))
    log = rv.scans(spark, sf).where("unit_qty = 0").select(*columns, F.lit(1).alias("version"))
    return read_snapshot(base, log, ["scan_id"], [F.col("version")], unique_base=True)


@query(
    "category_code bigint, trx bigint, net_sales double",
    """SELECT category_code, count(*) AS trx,
              sum(unit_qty * CASE WHEN item_id % 3 = 0 THEN CAST(base_price * 1.05 AS DECIMAL(10,2)) ELSE base_price END) AS net_sales
       FROM scans JOIN items ON item_upc = upc_code WHERE unit_qty <> 0 GROUP BY ALL""",
    ["scans", "items"],
)
def sql_on_views(spark, sf):
    """A report in SQL text on the base and snapshot views."""
    columns = ("scan_id", "item_upc", "unit_qty")
    base = rv.scans(spark, sf, voided=False).select(*columns, F.lit(0).alias("version"))
    log = rv.scans(spark, sf).where("unit_qty = 0").select(*columns, F.lit(1).alias("version"))
    publish_views("retail_scans", base, log, ["scan_id"], [F.col("version")], unique_base=True)
    items = rv.items(spark, sf).withColumn("version", F.lit(0))
    dearer = items.where("item_id % 3 = 0").withColumns(
        {"base_price": (F.col("base_price") * F.lit(1.05).cast("decimal(3,2)")).cast("decimal(10,2)"), "version": F.lit(1)})
    publish_views("retail_item_master", items, dearer, ["item_id"], [F.col("version")], unique_base=True)
    return spark.sql("""
        SELECT category_code, count(*) AS trx, sum(unit_qty * base_price) AS net_sales
        FROM retail_scans_rt JOIN retail_item_master_rt ON item_upc = upc_code
        WHERE unit_qty != 0
        GROUP BY category_code""")


@query(_VERSION, _LATEST, ["scans"])
def upsert_moving_partitions(spark, sf):
    """Upsert by one key where a later version may lie in another partition."""
    path = new_folder(spark, "scan_versions")
    rows = _with_status(spark, sf).withColumn("scan_year", F.substring("scan_datetime", 1, 4).cast("int"))
    order = [F.col(c) for c in VERSION_ORDER]
    base = latest_per_key(rows.where("status = 'O'"), ["version_key"], order)
    overwrite_table(base, path, ["scan_year"])
    upsert_table(spark, path, rows.where("status <> 'O'"), ["version_key"], order, ["scan_year"])
    return read_table(spark, path)


_ITEM = "item_id bigint, upc_code text, category_code bigint, base_price double"


@query(_ITEM, "SELECT * FROM items", ["items"])
def read_optimized(spark, sf):
    """Base files only: versions that wait in the log do not show."""
    base, log = new_folder(spark, "item_master"), new_folder(spark, "item_log")
    overwrite_table(rv.items(spark, sf), base)
    append_rows(rv.item_changes(spark, sf), log)
    return read_base(spark, base)


@query("item_id bigint, op text, base_price double, seq bigint", "SELECT * FROM changes UNION ALL SELECT * FROM changes",
       ["changes"])
def bulk_append(spark, sf):
    """Appending twice keeps both copies: no key lookup."""
    path = new_folder(spark, "item_log")
    append_rows(rv.item_changes(spark, sf), path)
    append_rows(rv.item_changes(spark, sf), path)
    return read_table(spark, path)


@query(_ITEM, "SELECT * FROM changed_items", ["changed_items"])
def apply_changes(spark, sf):
    return apply_feed(rv.items(spark, sf), rv.item_changes(spark, sf), ["item_id"], [F.col("seq")])


@query(
    "upc_code text, base_price double, category_code bigint",
    "SELECT upc_code, base_price, category_code FROM items WHERE item_id < 1000000000000 AND base_price > 901",
    ["items"],
)
def pushed_scan(spark, sf):
    """Projection and predicate evaluated at the source."""
    part = read_table(
        spark, f"{sf}/part.parquet", columns=["p_partkey", "p_retailprice", "p_brand"],
        where=(F.col("p_size") <= rv.MADE_UP_SIZE) & (F.col("p_retailprice") > 901),
    )
    return part.select(
        rv.upc(F.col("p_partkey")).alias("upc_code"), F.col("p_retailprice").alias("base_price"),
        rv.category_code().alias("category_code"),
    )


@query(
    "item_id bigint, base_price double",
    """SELECT item_id, CASE WHEN case_qty <= 10
           THEN CAST(base_price * (0.9 + 0.2 * (CAST(case_qty - 1 AS DECIMAL(4,0)) * 0.02)) AS DECIMAL(10,2))
           ELSE base_price END AS base_price FROM items""",
    ["items"],
)
def update_prices(spark, sf):
    items = rv.items(spark, sf)
    draw = (F.col("case_qty") - 1).cast("decimal(4,0)") * F.lit(Decimal("0.02"))
    return item_ops.update_prices(items, items.where("case_qty <= 10"), draw)


@query(_ITEM, "SELECT * FROM items WHERE NOT (item_id >= 1000000000000 AND case_qty = 50)", ["items"])
def delete_items(spark, sf):
    items = rv.items(spark, sf)
    gone = items.where((F.col("item_id") >= rv.MADE_UP_FROM) & (F.col("case_qty") == 50))
    return item_ops.remove_rows(items, gone, "item_id")


@query("next_item_id bigint", "SELECT greatest(coalesce(max(item_id) + 1, 50000), 50000) AS next_item_id FROM items", ["items"])
def next_item_id(spark, sf):
    return item_ops.next_item_id(rv.items(spark, sf))


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    """A code per customer: pairs share one, and one segment collides with known codes."""
    key = F.col("c_custkey")
    made_up = F.concat(F.lit("2"), F.lpad(F.floor(key / 2).cast("string"), 10, "0"))
    return rv.table(spark, sf, "customer").select(
        (20010 + 10 * F.col("c_nationkey")).cast("bigint").alias("category_code"),
        F.when(F.col("c_mktsegment") == "BUILDING", rv.upc(key)).otherwise(made_up).alias("upc_code"),
    )


@query(
    "item_id bigint, upc_code text, category_code bigint, base_price double, case_qty bigint, _frequency bigint",
    """SELECT item_id, upc_code, category_code, base_price, case_qty, _frequency FROM items
       UNION ALL
       SELECT (SELECT greatest(coalesce(max(item_id) + 1, 50000), 50000) FROM items) - 1 + row_number() OVER (
                  ORDER BY ('0x' || substr(md5(upc_code), 1, 8))::BIGINT % 4096, upc_code),
              upc_code, category_code, 1.00, 1, 1
       FROM (SELECT 20010 + 10 * c_nationkey AS category_code,
                    CASE WHEN c_mktsegment = 'BUILDING' THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0')
                         ELSE '2' || lpad(CAST(c_custkey // 2 AS VARCHAR), 10, '0') END AS upc_code
             FROM customer QUALIFY row_number() OVER (PARTITION BY upc_code ORDER BY category_code) = 1) c
       WHERE upc_code NOT IN (SELECT upc_code FROM items)""",
    ["items"],
)
def insert_new_items(spark, sf):
    return item_ops.insert_new_items(rv.items(spark, sf), _candidates(spark, sf))


@query(
    "scan_id text, due_at text",
    """SELECT scan_id, due_at FROM (
           SELECT scan_id, scan_ts + to_seconds(CAST(30 + CAST(item_upc AS BIGINT) % 61 AS BIGINT)) AS due_at
           FROM timed_scans WHERE unit_qty = 0)
       WHERE NOT due_at <= TIMESTAMP '2024-01-15 12:00:00'""",
    ["timed_scans"],
)
def remove_due(spark, sf):
    """Pending voids without those that are due now."""
    delay = (F.col("item_upc").cast("bigint") % 61 + 30).cast("int")
    pending = rv.timed_scans(spark, sf).where("unit_qty = 0").select(
        "scan_id", F.timestamp_add("SECOND", delay, F.col("scan_ts")).alias("due_at")
    )
    due = pending.where(is_due(F.col("due_at"), F.lit(NOW).cast("timestamp_ntz")))
    return item_ops.remove_rows(pending, due, "scan_id")


@query(
    "item_upc text, orphan_rows bigint",
    """SELECT item_upc, count(*) AS orphan_rows FROM scans
       WHERE item_upc NOT IN (SELECT item_upc FROM dimension) GROUP BY ALL""",
    ["scans", "dimension"],
)
def fk_orphans(spark, sf):
    """Scans of items outside the catalogue."""
    catalogue = rv.items(spark, sf).where(F.col("item_id") < rv.MADE_UP_FROM)
    return orphan_keys(rv.scans(spark, sf), catalogue, "item_upc", "upc_code")


@query(
    "version_key text, key_rows bigint",
    """SELECT version_key, count(*) AS key_rows FROM scans WHERE unit_qty <> 0 GROUP BY ALL HAVING count(*) > 1""",
    ["scans"],
)
def unique_violations(spark, sf):
    """Voids have no key here, which a unique key allows."""
    keys = rv.scans(spark, sf).select(F.when(F.col("unit_qty") != 0, F.col("version_key")).alias("version_key"))
    return duplicate_keys(keys, ["version_key"])


@query(
    "scan_id text, value text",
    """SELECT scan_id, '{"scan_id":"' || scan_id || '","store_id":' || store_id || ',"scan_datetime":"' || scan_datetime
              || '","item_upc":"' || item_upc || '","unit_qty":' || unit_qty || ',"unit_price":' || unit_price || '}' AS value
       FROM scans""",
    ["scans"],
)
def scan_json(spark, sf):
    scans = rv.scans(spark, sf)
    return scans.select("scan_id", scan_record(scans).alias("value"))


@query(
    "seq text, problem text, unit_price double",
    """SELECT scan_id AS seq,
              CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'missing unit_price'
                   WHEN 'purchase' THEN 'negative quantity' END AS problem,
              CASE WHEN event_type = 'signup' THEN NULL ELSE unit_price END AS unit_price
       FROM timed_scans WHERE event_type <> 'error'
       UNION ALL SELECT scan_id, 'malformed', NULL FROM timed_scans WHERE event_type = 'error'""",
    ["timed_scans"],
)
def contract_check(spark, sf):
    checked = check_contract(scan_lines(spark, sf))
    price = F.when(F.col("problem").isNull() | (F.col("problem") != "malformed"), F.col("unit_price"))
    return checked.select("seq", "problem", price.alias("unit_price"))


def scan_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Timed scans as JSON lines, some kinds torn, incomplete or with a bad quantity."""
    event = F.col("event_type")
    typed = rv.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("scan_id"),
        F.col("user_id").alias("store_id"),
        F.col("ts").alias("scan_ts"),
        rv.upc(F.get_json_object("props", "$.k")).alias("item_upc"),
        F.when(event == "purchase", -1).otherwise(1).alias("unit_qty"),
        F.when(event != "signup", F.col("value").try_cast("decimal(8,2)")).alias("unit_price"),
        event.alias("event_type"),
    )
    line = scan_record(typed)
    torn = F.substring(line, F.lit(1), F.length(line) - 5)
    return typed.select(
        F.col("scan_id").alias("seq"), F.when(event == "error", torn).otherwise(line).alias("value")
    )


@query(
    "p_partkey bigint, p_name text, p_size bigint",
    "SELECT p_partkey, p_name, p_size FROM part",
)
def drop_columns(spark, sf):
    """Metadata columns of a table format go, and the label for scoring."""
    part = rv.table(spark, sf, "part").select("p_partkey", "p_name", "p_size", F.col("p_brand").alias("target"))
    marked = part.withColumns({
        "_hoodie_commit_time": F.lit("20240101"), "_hoodie_commit_seqno": F.col("p_partkey").cast("string"),
        "_hoodie_record_key": F.col("p_partkey").cast("string"), "_hoodie_partition_path": F.lit(""),
        "_hoodie_file_name": F.input_file_name(),
    })
    return drop_metadata(marked).drop("target")
