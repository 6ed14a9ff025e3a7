"""Uniqueness of arriving scans, by a stored filter of the keys of each day."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillhouse.operators import keys
from tillhouse.registry.core import query
from tillhouse.session import new_folder
from tillhouse.sources import retail_views as rv
from tillhouse.sources.writers import write_partitioned

KEY, DAY = ["scan_id"], ["scan_datestamp"]

# Two thirds of the scans are stored. The others arrive, some of them twice, and some stored ones arrive under the next day.
_ARRIVING = """
    SELECT scan_id FROM timed_scans WHERE event_id % 3 = 0
    UNION ALL SELECT scan_id FROM timed_scans WHERE event_id % 60 = 0
    UNION ALL SELECT scan_id FROM timed_scans WHERE event_id % 3 <> 0 AND event_id % 50 = 1"""


def _tables(spark, sf):
    """Paths of a table by day and of its filter, the table, and the arriving rows."""
    scans = rv.timed_scans(spark, sf).withColumn("scan_datestamp", F.to_date("scan_ts"))
    number = F.col("scan_id").cast("bigint")
    table_path, filter_path = new_folder(spark, "scans"), new_folder(spark, "key_filter")
    write_partitioned(scans.where(number % 3 != 0), table_path, DAY)
    table = spark.read.schema(scans.schema).parquet(table_path)
    keys.refresh_key_filter(table, filter_path, KEY, DAY)
    moved = scans.where((number % 3 != 0) & (number % 50 == 1)).withColumn("scan_datestamp", F.date_add("scan_datestamp", 1))
    arriving = scans.where(number % 3 == 0).unionByName(scans.where(number % 60 == 0)).unionByName(moved)
    return table_path, filter_path, table, arriving


@query(
    "scan_id text, new_rows bigint, stored_rows bigint",
    f"""SELECT scan_id, a.n AS new_rows, coalesce(s.n, 0) AS stored_rows
        FROM (SELECT scan_id, count(*) AS n FROM ({_ARRIVING}) GROUP BY scan_id) AS a
        LEFT JOIN (SELECT scan_id, count(*) AS n FROM timed_scans WHERE event_id % 3 <> 0 GROUP BY scan_id) AS s USING (scan_id)
        WHERE a.n + coalesce(s.n, 0) > 1""",
    ["timed_scans"],
)
def repeated_arrivals(spark, sf):
    _, filter_path, table, arriving = _tables(spark, sf)
    filters = keys.read_key_filter(table, filter_path, DAY)
    return keys.repeated_arrivals(arriving, keys.stored_keys(arriving, table, filters, KEY, DAY), KEY)


@query(
    "day text, scans bigint",
    f"""SELECT CAST(CAST(scan_ts AS DATE) AS VARCHAR) AS day, count(*) AS scans FROM timed_scans
        WHERE event_id % 3 <> 0 OR scan_id NOT IN (SELECT scan_id FROM ({_ARRIVING}) GROUP BY scan_id HAVING count(*) > 1)
        GROUP BY ALL""",
    ["timed_scans"],
)
def unique_append(spark, sf):
    """Rows by day after an append that was run twice, as after a failure."""
    table_path, filter_path, table, arriving = _tables(spark, sf)
    for _ in range(2):
        keys.append_unique(arriving, table, table_path, filter_path, KEY, DAY)
        table = spark.read.schema(table.schema).parquet(table_path)
    return table.groupBy(F.col("scan_datestamp").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("scans"))
