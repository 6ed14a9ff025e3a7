"""Scheduled jobs for spark-submit.

    spark-submit -m tillhouse.jobs silver --bronze /lake/bronze --silver /lake/silver [--run-date 2024-01-15 | --full]
    spark-submit -m tillhouse.jobs inventory --scans /lake/bronze/retail_scans --table /lake/silver/inventory_delta
    spark-submit -m tillhouse.jobs dashboard --bronze /lake/bronze
    spark-submit -m tillhouse.jobs ingest --arriving /lake/arriving --log /lake/scan_log --checkpoint /lake/checkpoints/scans
    spark-submit -m tillhouse.jobs compact --log /lake/scan_log --table /lake/bronze/retail_scans
    spark-submit -m tillhouse.jobs rollups --bronze /lake/bronze --silver /lake/silver --log /lake/scan_log
    spark-submit -m tillhouse.jobs ingest-items --arriving /lake/item_changes --log /lake/item_log --checkpoint /lake/checkpoints/items
    spark-submit -m tillhouse.jobs fold-items --items /lake/bronze/retail_item_master --log /lake/item_log --table /lake/items
    spark-submit -m tillhouse.jobs monitor --arriving /lake/arriving --stores /lake/bronze/retail_stores --counts /lake/activity --checkpoint /lake/checkpoints/activity
    spark-submit -m tillhouse.jobs append-unique --arriving /lake/new_scans --table /lake/bronze/retail_scans --filter /lake/scan_keys

``append-unique`` stores the scans of a table whose ids are new, shows the others, and keeps a filter of the ids of each day
(``--refresh`` makes it anew first). ``rollups`` reads batches of the scan log before ``compact`` drops them.

Every job takes its date as an argument, so a day can be run again; without
one, a silver run takes yesterday and the others today, in the report zone.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.temporal import today_in_zone, with_scan_time
from tillhouse.operators import keys
from tillhouse.operators.versions import current_scans, latest_per_key
from tillhouse.plans import dashboard, inventory, rollups, silver
from tillhouse.session import configure
from tillhouse.schemas import ITEM_MASTER, RETAIL_SCANS
from tillhouse.sources.paths import table_exists
from tillhouse.sources.readers import read_table
from tillhouse.sources.writers import write_partitioned
from tillhouse.streaming import changes, ingest, logs, monitor, sources

# Table folders below a bronze path.
BRONZE = {
    "scans": "retail_scans",
    "stores": "retail_stores",
    "item_master": "retail_item_master",
    "item_categories": "retail_item_categories",
}


def bronze_tables(spark: SparkSession, path: str, source: str = "parquet") -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{path}/{folder}", source) for name, folder in BRONZE.items()}


def scans_of_days(scans: DataFrame, first: dt.date, until: dt.date | None = None) -> DataFrame:
    """Versions of the scans of these days, chosen before the latest of each is looked for.

    All versions of a scan have its day, so nothing is lost, and only the folders of these days are read. A predicate on
    the time would not pass a window over ``scan_id``.
    """
    if "scan_datestamp" not in scans.columns:
        return scans
    day = F.col("scan_datestamp")
    return scans.where(day >= F.lit(first)) if until is None else scans.where((day >= F.lit(first)) & (day < F.lit(until)))


def run_silver(spark: SparkSession, args: argparse.Namespace) -> None:
    day = None if args.full else args.run_date or today_in_zone() - dt.timedelta(days=1)
    silver.build_silver(spark, bronze_tables(spark, args.bronze, args.source), args.silver, day)


def run_inventory(spark: SparkSession, args: argparse.Namespace) -> None:
    day = args.run_date or today_in_zone()
    scans = scans_of_days(read_table(spark, args.scans, args.source), day - dt.timedelta(days=args.lookback_days), day)
    deltas = inventory.inventory_delta(current_scans(scans), day, args.lookback_days)
    inventory.write_inventory_delta(spark, deltas, args.table, create=not table_exists(spark, args.table))


def run_dashboard(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = bronze_tables(spark, args.bronze, args.source)
    today = args.run_date or today_in_zone()
    week = current_scans(scans_of_days(tables["scans"], today - dt.timedelta(days=dashboard.WINDOW_DAYS)))
    dashboard.sales_today(week, today).show()
    dashboard.average_day(week, today).show()
    dashboard.top_categories(
        current_scans(tables["scans"]), tables["stores"], tables["item_master"], tables["item_categories"]
    ).show(truncate=False)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Log what has arrived since the last run."""
    ingest.log_scans(sources.scan_files(spark, args.arriving), args.log, args.checkpoint).awaitTermination()


def run_compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fold the log into the table of scans, then drop what is folded."""
    if not table_exists(spark, args.log):
        return
    log = logs.read_log(spark, args.log, RETAIL_SCANS)
    last = logs.last_batch(log)
    folded = ingest.with_scan_day(log.where(log[logs.BATCH] <= last))
    if not table_exists(spark, args.table):
        write_partitioned(latest_per_key(folded, ingest.SCAN_KEY, ingest.version_order()), args.table, ["scan_datestamp"])
    logs.compact(spark, args.table, folded, ingest.SCAN_KEY, ingest.version_order(), ["scan_datestamp"])
    logs.drop_batches(spark, args.log, last)


def run_rollups(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bring the batches of scans logged since the last run into details and rollups, whatever days they are of."""
    if not table_exists(spark, f"{args.silver}/rollups"):
        rollups.create_rollups(spark, args.silver)
    if table_exists(spark, args.log):
        log = logs.read_log(spark, args.log, RETAIL_SCANS, rollups.last_recorded(spark, args.silver))
        last = logs.last_batch(log)
        if last >= 0:
            bronze = bronze_tables(spark, args.bronze, args.source)
            newest = latest_per_key(log.where(log[logs.BATCH] <= last), ingest.SCAN_KEY, ingest.version_order())
            dimension = read_table(spark, f"{args.silver}/items_categories")
            rollups.record_changes(spark, args.silver, silver.sales_detail(newest, bronze["stores"], dimension), last)
    rollups.fold_rollups(spark, args.silver)


ITEM_CHANGES = T.StructType().add("item_id", "integer").add("op", "string").add("base_price", "decimal(10,2)").add("seq", "long")
ITEMS = changes.Feed(ITEM_MASTER, ITEM_CHANGES, ("item_id",), ("seq",))


def run_ingest_items(spark: SparkSession, args: argparse.Namespace) -> None:
    """Log the item changes that have arrived since the last run."""
    arriving = sources.table_files(spark, args.arriving, ITEM_CHANGES, source="json")
    ingest.log_item_changes(arriving, args.log, args.checkpoint).awaitTermination()


def run_fold_items(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fold logged item changes, deletions included, into the folded item master, made from ``--items`` at first."""
    if not table_exists(spark, args.table):
        changes.create_table(read_table(spark, args.items, args.source), args.table, ITEMS)
    changes.fold(spark, args.table, args.log, ITEMS, args.keep_tombstones)


def run_monitor(spark: SparkSession, args: argparse.Namespace) -> None:
    """Count the scans that have arrived by minute and zone, fold the counts, and keep the closed minutes."""
    stores = read_table(spark, args.stores, args.source).select("store_id", "timezone")
    scans = with_scan_time(sources.scan_files(spark, args.arriving)).join(stores, "store_id")
    monitor.log_closed_minutes(scans, f"{args.counts}/closed", f"{args.checkpoint}/closed", args.delay).awaitTermination()
    monitor.log_minutes_by_day(scans, f"{args.counts}/log", f"{args.checkpoint}/log").awaitTermination()
    monitor.fold_minute_counts(spark, f"{args.counts}/log", f"{args.counts}/minutes")


def run_append_unique(spark: SparkSession, args: argparse.Namespace) -> None:
    """Append arriving scans with new ids to a table by day, and show those that repeat."""
    key, day = ingest.SCAN_KEY, ["scan_datestamp"]
    arriving = read_table(spark, args.arriving, args.source)
    if "scan_datestamp" not in arriving.columns:
        arriving = ingest.with_scan_day(arriving)
    if table_exists(spark, args.table):
        table = read_table(spark, args.table, args.source)
        if args.refresh or not table_exists(spark, args.filter):
            keys.refresh_key_filter(table, args.filter, key, day)
    else:
        table = spark.createDataFrame([], arriving.schema)
    keys.append_unique(arriving, table, args.table, args.filter, key, day).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tillhouse.jobs")
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, *paths: str) -> argparse.ArgumentParser:
        command = jobs.add_parser(name)
        command.set_defaults(run=run)
        command.add_argument("--run-date", type=dt.date.fromisoformat)
        command.add_argument("--source", default="parquet")
        for path in paths:
            command.add_argument(f"--{path}", required=True)
        return command

    job("silver", run_silver, "bronze", "silver").add_argument("--full", action="store_true")
    job("inventory", run_inventory, "scans", "table").add_argument("--lookback-days", type=int, default=1)
    job("dashboard", run_dashboard, "bronze")
    job("ingest", run_ingest, "arriving", "log", "checkpoint")
    job("compact", run_compact, "log", "table")
    job("append-unique", run_append_unique, "arriving", "table", "filter").add_argument("--refresh", action="store_true")
    job("rollups", run_rollups, "bronze", "silver", "log")
    job("ingest-items", run_ingest_items, "arriving", "log", "checkpoint")
    job("fold-items", run_fold_items, "items", "log", "table").add_argument("--keep-tombstones", type=int)
    job("monitor", run_monitor, "arriving", "stores", "counts", "checkpoint").add_argument("--delay", default="10 minutes")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName("tillhouse").getOrCreate())
    args.run(spark, args)


if __name__ == "__main__":
    main()
