"""Scans and item changes from streams into tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillhouse.functions.records import check_contract
from tillhouse.functions.temporal import event_time, parse_scan_time, scan_date
from tillhouse.operators.versions import apply_changes, latest_per_key
from tillhouse.streaming.logs import BATCH, start, store_batch, write_log

SCAN_KEY = ["scan_id"]
VERSION_KEY = ["scan_id", "unit_qty"]


def version_order(arrival: Sequence[str] = ()) -> list[Column]:
    """Later arrival wins; a void repeats the event time of its sale, so that
    time orders nothing. Within a batch without arrival columns the lower
    quantity is the void."""
    return [F.col(BATCH), *[F.col(c) for c in arrival], -F.col("unit_qty")]


def with_scan_day(scans: DataFrame) -> DataFrame:
    return scans.withColumn("scan_datestamp", scan_date(parse_scan_time(F.col("scan_datetime"))))


def append_scans(scans: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Bronze: store arriving scans as they are, partitioned by day."""
    writer = (
        with_scan_day(scans).writeStream.format("parquet").outputMode("append")
        .partitionBy("scan_datestamp").option("path", path).option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def log_scans(scans: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Log all versions of scans; see ``current_scans``."""
    return write_log(scans, path, checkpoint, available_now=available_now)


def current_scans(log: DataFrame, arrival: Sequence[str] = ()) -> DataFrame:
    """Latest version of every scan: sales, or their voids with quantity 0."""
    return latest_per_key(log, SCAN_KEY, version_order(arrival)).drop(BATCH)


def split_stream(lines: DataFrame, good_path: str, rejected_path: str, checkpoint: str) -> StreamingQuery:
    """Good scans to one log and rejected lines with their problem to another.

    A micro-batch is read and parsed once. Good scans keep the columns of their line other than its text, such as
    partition and offset, by which ``current_scans`` can order versions.
    """

    def store(batch: DataFrame, number: int) -> None:
        checked = check_contract(batch).persist()
        try:
            good = checked.where(F.col("problem").isNull()).drop("problem", "value")
            store_batch(good, number, good_path)
            rejected = checked.where(F.col("problem").isNotNull()).select(*lines.columns, "problem")
            store_batch(rejected, number, rejected_path)
        finally:
            checked.unpersist()

    return start(lines, store, checkpoint)


def log_distinct_scans(scans: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Log each scan and quantity once for a micro-batch; see ``distinct_scans``."""
    return write_log(
        scans, path, checkpoint, available_now=available_now, reduced=lambda batch: batch.dropDuplicates(VERSION_KEY)
    )


def distinct_scans(log: DataFrame) -> DataFrame:
    """Each scan and quantity once, however late a message is repeated: the first one logged."""
    return latest_per_key(log, VERSION_KEY, [-F.col(BATCH)]).drop(BATCH)


def distinct_within(scans: DataFrame, delay: str, time: str = "scan_ts") -> DataFrame:
    """A stream's scans without those repeated within ``delay`` of event time.

    State holds a scan and quantity until the watermark has passed its time by the delay, so its size follows the rate of
    arrival, not the history; ``distinct_scans`` finds repeats at any distance, on reading. A scan that is older than the
    watermark, which trails the latest time seen by the delay, is dropped: its minute counts as late in ``monitor``.
    """
    timed = event_time(scans, time).withWatermark(time, delay)
    once = timed.dropDuplicatesWithinWatermark(VERSION_KEY)
    return once.withColumn(time, F.col(time).cast("timestamp_ntz"))


def log_distinct_within(
    scans: DataFrame, path: str, checkpoint: str, delay: str, time: str = "scan_ts", available_now: bool = True
) -> StreamingQuery:
    return write_log(distinct_within(scans, delay, time), path, checkpoint, available_now=available_now)


def log_item_changes(changes: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    return write_log(changes, path, checkpoint, available_now=available_now)


def current_items(items: DataFrame, log: DataFrame, sequence: str = "seq") -> DataFrame:
    """Item master with the logged changes applied."""
    return apply_changes(items, log, ["item_id"], [F.col(sequence), F.col(BATCH)])
