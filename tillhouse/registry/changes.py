"""Tables kept up to date by changes: rollups by signed differences and folded change feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillhouse.plans import rollups, silver
from tillhouse.registry.core import query
from tillhouse.registry.sales import _BY_DAY, stored_dimensions
from tillhouse.session import new_folder
from tillhouse.sources import retail_views as rv
from tillhouse.sources.writers import write_partitioned
from tillhouse.streaming import changes, ingest, sources


def _late_voids(spark, sf) -> str:
    """Details and rollups of all sales before any void; then the voids, of all days, in two batches.

    The first batch is folded and also recorded once more, as after a failure; the second one stays in the log.
    """
    path = new_folder(spark, "silver")
    stores, items = stored_dimensions(spark, sf)
    sales = silver.sales_detail(rv.timed_scans(spark, sf, voided=False), stores, items)
    write_partitioned(sales, f"{path}/sales_detail", ["scan_datestamp"])
    rollups.create_rollups(spark, path)
    voids = silver.sales_detail(rv.timed_scans(spark, sf).where("unit_qty = 0"), stores, items)
    early = F.col("store_id") % 2 == 0
    rollups.record_changes(spark, path, voids.where(early), 0)
    rollups.fold_rollups(spark, path)
    rollups.record_changes(spark, path, voids.where(early), 0)
    rollups.record_changes(spark, path, voids.where(~early), 1)
    return path


@query(
    _BY_DAY,
    """SELECT CAST(scan_timestamp AS DATE) AS scan_date, category_code, category_name, region,
              sum(unit_qty) AS net_units, sum(net_sale) AS net_sales FROM timed_detail GROUP BY ALL""",
    ["timed_detail"],
)
def rollup_by_day_late_voids(spark, sf):
    """The rollup by day after late voids equals one made of the voided details."""
    return rollups.read_rollup(spark, _late_voids(spark, sf), "sales_by_day")


@query(
    "year bigint, month bigint, item_upc text, category_code bigint, category_name text, store_id bigint, "
    "city text, state text, region text, net_units bigint, net_sales double",
    """SELECT year(scan_timestamp) AS year, month(scan_timestamp) AS month, item_upc, category_code, category_name,
              store_id, city, state, region, sum(unit_qty) AS net_units, sum(net_sale) AS net_sales
       FROM timed_detail GROUP BY ALL""",
    ["timed_detail"],
)
def rollup_by_month_late_voids(spark, sf):
    """The rollup by month, with the second batch folded too."""
    path = _late_voids(spark, sf)
    rollups.fold_rollups(spark, path)
    return rollups.read_rollup(spark, path, "sales_by_month")


@query(
    "item_id bigint, upc_code text, category_code bigint, base_price double", "SELECT * FROM changed_items",
    ["changed_items"],
)
def stream_item_changes_folded(spark, sf):
    """The item change feed as a stream in two waves, the later changes first; each wave is folded, deletes included.

    The second wave's changes are older than those of the first for half of the items, and lose to them.
    """
    items, feed_rows = rv.items(spark, sf), rv.item_changes(spark, sf)
    table, log, checkpoint, arriving = (new_folder(spark, n) for n in ("items", "item_log", "checkpoint", "arriving"))
    columns = items.select("item_id", "upc_code", "category_code", "base_price")
    feed = changes.Feed(columns.schema, feed_rows.schema, ("item_id",), ("seq",))
    changes.create_table(columns, table, feed)
    late = (F.col("item_id") % 2 == 0) & (F.col("seq") == 1)
    for wave in (feed_rows.where(~late), feed_rows.where(late)):
        wave.repartition(4).write.mode("append").parquet(arriving)
        stream = sources.table_files(spark, arriving, feed_rows.schema, files_per_batch=2)
        ingest.log_item_changes(stream, log, checkpoint).awaitTermination()
        changes.fold(spark, table, log, feed)
    return changes.read_table(spark, table, feed)
