"""Units sold per day, store and item, kept by upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.temporal import parse_any_time, scan_date, scans_between, stamp
from tillhouse.sources.writers import upsert_table, write_partitioned

KEYS = ["delta_date", "store_id", "item_upc"]


def inventory_delta(
    scans: DataFrame,
    run_date: dt.date,
    lookback_days: int = 1,
    as_of: dt.datetime | None = None,
    fixed_format: bool = False,
) -> DataFrame:
    """Units sold on each of the ``lookback_days`` full days before ``run_date``.

    Times given as text are read in Spark's default format; ``fixed_format``
    states that all of them are ``yyyy-MM-dd HH:mm:ss`` and so lets the file
    statistics of the text skip other days. The sum is 64 bit and becomes an
    int at the end; a sum that does not fit is NULL.
    """
    if "scan_ts" not in scans.columns and not fixed_format:
        scans = scans.withColumn("scan_ts", parse_any_time(F.col("scan_datetime")))
    first = run_date - dt.timedelta(days=lookback_days)
    typed = scans_between(scans, first, run_date)
    valid = typed.dropna(subset=["store_id", "item_upc", "unit_qty"])
    deltas = valid.groupBy(
        scan_date(F.col("scan_ts")).alias("delta_date"), "store_id", "item_upc"
    ).agg(F.sum("unit_qty").try_cast("int").alias("net_quantity_delta"))
    return stamp(deltas, "last_updated", as_of)


def write_inventory_delta(spark: SparkSession, deltas: DataFrame, path: str, create: bool = False) -> None:
    """Upsert by day, store and item; the latest ``last_updated`` wins."""
    if create:
        write_partitioned(deltas, path, ["delta_date"])
        return
    upsert_table(
        spark, path, deltas, KEYS, [F.col("last_updated")], ["delta_date"], partition_fixed_by_key=True
    )
