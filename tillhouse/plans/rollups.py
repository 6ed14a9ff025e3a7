"""Daily and monthly rollups kept by signed changes.

A batch of new versions of scans, of whatever days, changes the rollups by the difference of what the scans count now and
what they counted before: the old image is subtracted and the new one added. A void of an older day, logged late, so costs
its own groups only, not its day or month. Differences are logged by batch and folded from time to time (``streaming.sums``).

Besides units and sales a stored group counts its scans, those with units and those with a sale, so that sums of NULL
stay NULL and a group without scans disappears, as in a rebuild from the details.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.money import CENT, cents
from tillhouse.functions.temporal import scan_date
from tillhouse.operators.versions import latest_per_key, with_keys_of
from tillhouse.plans.silver import DETAIL_COLUMNS
from tillhouse.sources.paths import exists, scratch, table_exists
from tillhouse.sources.readers import read_table
from tillhouse.sources.writers import upsert_table
from tillhouse.streaming import sums
from tillhouse.streaming.logs import BATCH, last_batch, read_log, store_batch

SUMS = ("scan_rows", "unit_rows", "units", "sale_rows", "sale_cents")


class Rollup(NamedTuple):
    name: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...]
    derived: tuple[tuple[str, Column], ...]


def rollups() -> tuple[Rollup, Rollup]:
    """The rollups by day and by month."""
    time = F.col("scan_timestamp")
    return (
        Rollup("sales_by_day", ("scan_date", "category_code", "category_name", "region"), ("scan_date",),
               (("scan_date", scan_date(time)),)),
        Rollup("sales_by_month",
               ("year", "month", "item_upc", "category_code", "category_name", "store_id", "city", "state", "region"),
               ("year", "month"), (("year", F.year(time)), ("month", F.month(time)))),
    )


def measures(detail: DataFrame, rollup: Rollup, sign: Column | None = None) -> DataFrame:
    """Stored sums of detail rows, each counted ``sign`` times."""
    times = F.lit(1) if sign is None else sign
    sale = cents(F.col("net_sale"))
    values = (
        times, F.when(F.col("unit_qty").isNotNull(), times), F.col("unit_qty") * times,
        F.when(sale.isNotNull(), times), sale * times,
    )
    totals = [F.coalesce(F.sum(v.cast("bigint")), F.lit(0)).alias(name) for name, v in zip(SUMS, values)]
    keyed = detail.withColumns(dict(rollup.derived))
    return keyed.groupBy(*rollup.keys).agg(*totals)


def published(stored: DataFrame, rollup: Rollup) -> DataFrame:
    """Stored sums as the rollup's visible columns."""
    sales = (F.col("sale_cents").cast("decimal(20,0)") * F.lit(CENT)).cast("decimal(20,2)")
    return stored.where(F.col("scan_rows") != 0).select(
        *rollup.keys, F.when(F.col("unit_rows") != 0, F.col("units")).alias("net_units"),
        F.when(F.col("sale_rows") != 0, sales).alias("net_sales"))


def _paths(silver_path: str, rollup: Rollup) -> tuple[str, str]:
    return f"{silver_path}/rollups/{rollup.name}", f"{silver_path}/rollups/{rollup.name}_changes"


def _schema(detail: DataFrame, rollup: Rollup) -> T.StructType:
    return measures(detail.limit(0), rollup).schema


def create_rollups(spark: SparkSession, silver_path: str, batch: int = -1) -> None:
    """Store both rollups of ``sales_detail``, which holds everything up to ``batch``."""
    detail = read_table(spark, f"{silver_path}/sales_detail")
    for rollup in rollups():
        sums.create(measures(detail, rollup), _paths(silver_path, rollup)[0], rollup.partition_by, batch)


def signed_images(detail: DataFrame, newest: DataFrame, days: Sequence) -> DataFrame:
    """New images of scans with ``_sign`` 1 and the old ones that ``detail`` holds with -1.

    Only the folders of ``days``, those of the new images, are read: a void repeats the time of its sale.
    """
    day = F.col("scan_datestamp")
    there = [d for d in days if d is not None]
    pruned = day.isin(there) if len(there) == len(days) else day.isin(there) | day.isNull()
    old = with_keys_of(detail.where(pruned).select(*DETAIL_COLUMNS), newest, ["scan_id"], "left_semi")
    return newest.withColumn("_sign", F.lit(1)).unionByName(old.withColumn("_sign", F.lit(-1)))


def record_changes(spark: SparkSession, silver_path: str, changed: DataFrame, batch: int, order: Sequence[Column] = ()) -> None:
    """Bring new versions of scans, as detail rows, into ``sales_detail`` and log what they change in the rollups.

    The last of a scan's versions by ``order`` (by default the least quantity, which a void has) replaces the stored one.
    The differences of a batch are logged before the details change, and a logged batch isn't computed again, so a run
    that fails anywhere can be repeated. Versions that are stored already, as in such a run, rewrite no partition.
    """
    order = list(order) or [-F.col("unit_qty")]
    path = f"{silver_path}/sales_detail"
    with scratch(spark, "changes") as folder:
        latest_per_key(changed.select(*DETAIL_COLUMNS, *[c for c in changed.columns if c not in DETAIL_COLUMNS]), ["scan_id"], order).select(
            *DETAIL_COLUMNS).write.parquet(f"{folder}/newest")
        newest = spark.read.parquet(f"{folder}/newest")
        days = [r[0] for r in newest.select("scan_datestamp").distinct().collect()]  # days of the calendar
        # Images that are the same before and after cancel out; only what differs is counted and brought into the details.
        signed = signed_images(read_table(spark, path), newest, days).groupBy(*DETAIL_COLUMNS).agg(
            F.sum("_sign").alias("_sign"), F.max("_sign").alias("_newest"))
        signed.where("_sign <> 0").write.parquet(f"{folder}/images")
        images = spark.read.schema(signed.schema).parquet(f"{folder}/images")
        for rollup in rollups():
            log = _paths(silver_path, rollup)[1]
            if not exists(spark, f"{log}/{BATCH}={batch}"):
                changes = measures(images, rollup, F.col("_sign"))
                store_batch(changes.where(" OR ".join(f"{c} <> 0" for c in SUMS)), batch, log)
        differing = images.where("_newest = 1").select(*DETAIL_COLUMNS)
        if not differing.isEmpty():
            upsert_table(spark, path, differing, ["scan_id"], [-F.col("unit_qty")], ["scan_datestamp"],
                         partition_fixed_by_key=True, incoming_wins=True)


def fold_rollups(spark: SparkSession, silver_path: str) -> None:
    """Bring the logged differences into the stored rollups."""
    detail = read_table(spark, f"{silver_path}/sales_detail")
    for rollup in rollups():
        path, log = _paths(silver_path, rollup)
        sums.fold(spark, path, log, _schema(detail, rollup), rollup.keys, SUMS, rollup.partition_by, "scan_rows")


def read_rollup(spark: SparkSession, silver_path: str, name: str) -> DataFrame:
    """A rollup with all logged differences."""
    rollup = next(r for r in rollups() if r.name == name)
    detail = read_table(spark, f"{silver_path}/sales_detail")
    stored = sums.read(spark, *_paths(silver_path, rollup), _schema(detail, rollup), rollup.keys, SUMS)
    return published(stored, rollup)


def last_recorded(spark: SparkSession, silver_path: str) -> int:
    """The last batch in the rollups or their logs; -1 before the first. A batch whose log was cut short counts as not recorded."""
    found = []
    detail = read_table(spark, f"{silver_path}/sales_detail")
    for rollup in rollups():
        path, log = _paths(silver_path, rollup)
        schema = _schema(detail, rollup)
        folded = sums.read_base(spark, path, schema).agg(F.max(sums.FOLDED)).first()[0] if table_exists(spark, path) else None
        logged = last_batch(read_log(spark, log, schema)) if table_exists(spark, log) else None
        found.append(max(x if x is not None else -1 for x in (folded, logged)))
    return min(found)
