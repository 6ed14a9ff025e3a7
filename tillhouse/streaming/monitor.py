"""Live activity: minute counts and the state of every time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillhouse.functions.temporal import event_time
from tillhouse.operators.activity import read_messages, zone_state
from tillhouse.operators.versions import latest_per_key
from tillhouse.streaming import sums
from tillhouse.streaming.logs import BATCH, write_log

MINUTE_KEY = ["minute", "timezone"]
ZONE_KEY = ["timezone"]
MINUTE_SUMS = ["scans", "voids", "units"]
MINUTE_TABLE = (
    T.StructType().add("day", "date").add("minute", "timestamp_ntz").add("timezone", "string")
    .add("scans", "long").add("voids", "long").add("units", "long")
)


def minute_counts(scans: DataFrame, time: str = "scan_ts") -> DataFrame:
    """Scans, voids and units per minute and time zone."""
    return scans.groupBy(F.date_trunc("minute", F.col(time)).cast("timestamp_ntz").alias("minute"), "timezone").agg(
        F.count(F.lit(1)).alias("scans"),
        F.count(F.when(F.col("unit_qty") == 0, 1)).alias("voids"),
        F.sum("unit_qty").alias("units"),
    )


def log_minute_counts(scans: DataFrame, path: str, checkpoint: str, time: str = "scan_ts",
                      available_now: bool = True) -> StreamingQuery:
    """Log the counts of every micro-batch.

    Counts of the batches are added up by the reader, so a scan counts however late it comes: there is no watermark,
    and no state to keep.
    """
    return write_log(
        scans, path, checkpoint, available_now=available_now, reduced=lambda batch: minute_counts(batch, time)
    )


def current_minute_counts(log: DataFrame) -> DataFrame:
    return log.groupBy(*MINUTE_KEY).agg(*[F.sum(c).alias(c) for c in ("scans", "voids", "units")])


def fold_minute_counts(spark: SparkSession, log_path: str, table_path: str) -> None:
    """Bring the logged counts into a table by day and drop them from the log, so that reading costs a row a minute and
    zone however many micro-batches there were. A late scan's minute is changed like any other's."""
    sums.fold(spark, table_path, log_path, MINUTE_TABLE, MINUTE_TABLE.names[:3], MINUTE_SUMS, ["day"])


def read_minute_counts(spark: SparkSession, table_path: str, log_path: str) -> DataFrame:
    """Counts of every minute and zone, folded or not."""
    return sums.read(spark, table_path, log_path, MINUTE_TABLE, MINUTE_TABLE.names[:3], MINUTE_SUMS)


def log_minutes_by_day(scans: DataFrame, path: str, checkpoint: str, time: str = "scan_ts", available_now: bool = True) -> StreamingQuery:
    """Log the counts of every micro-batch for ``fold_minute_counts``."""

    def counts(batch: DataFrame) -> DataFrame:
        return minute_counts(batch, time).select(F.col("minute").cast("date").alias("day"), *MINUTE_KEY, *MINUTE_SUMS)

    return write_log(scans, path, checkpoint, available_now=available_now, reduced=counts)


def closed_minutes(scans: DataFrame, delay: str, time: str = "scan_ts") -> DataFrame:
    """A stream of the scans of each minute and zone, once no scan of it is expected any more.

    In append mode a minute comes out when the watermark, ``delay`` behind the latest time seen, has passed its end: the
    current rate, which is never taken back. State holds the open minutes only. Scans that come later are not in it.
    """
    timed = event_time(scans, time).withWatermark(time, delay)
    counts = timed.groupBy(F.window(time, "1 minute"), "timezone").agg(F.count(F.lit(1)).alias("on_time"))
    return counts.select(F.col("window.start").cast("timestamp_ntz").alias("minute"), "timezone", "on_time")


def log_closed_minutes(
    scans: DataFrame, path: str, checkpoint: str, delay: str, time: str = "scan_ts", available_now: bool = True
) -> StreamingQuery:
    return write_log(closed_minutes(scans, delay, time), path, checkpoint, available_now=available_now)


def late_counts(closed: DataFrame, counts: DataFrame) -> DataFrame:
    """Closed minutes with scans that came too late for them: ``counts`` knows all, ``closed`` those on time.

    A minute that only late scans belong to never came out of the stream; it is late as a whole once a later minute of its
    zone is closed.
    """
    last = closed.groupBy("timezone").agg(F.max("minute").alias("_last"))
    known = counts.join(last, "timezone").where(F.col("minute") <= F.col("_last")).join(closed, MINUTE_KEY, "left")
    late = F.col("scans") - F.coalesce("on_time", F.lit(0))
    return known.select(*MINUTE_KEY, late.alias("late")).where(F.col("late") > 0)


def log_zone_state(lines: DataFrame, order: Column, path: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Keep the state of every zone up to date; bad lines and unknown types are skipped."""
    messages = read_messages(lines).where(F.col("problem").isNull())
    return write_log(zone_state(messages, order), path, checkpoint, "update", available_now=available_now)


def current_zone_state(log: DataFrame) -> DataFrame:
    return latest_per_key(log, ZONE_KEY, [F.col(BATCH)]).drop(BATCH)
