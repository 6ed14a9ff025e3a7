"""Activity of the stores: batch summaries and the state of every time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.records import parsed_once, scan_json
from tillhouse.functions.temporal import clock_text, format_time, utc_to_local, with_scan_time
from tillhouse.operators.totals import running_total
from tillhouse.schemas import ACTIVITY_MESSAGE, MESSAGE_TYPES
from tillhouse.session import staged


def distinct_timezones(stores: DataFrame) -> DataFrame:
    return stores.select("timezone").distinct()


def stores_in_zone(stores: DataFrame, zone: str) -> DataFrame:
    return stores.where(F.col("timezone") == zone)


def stores_per_timezone(stores: DataFrame) -> DataFrame:
    return stores.groupBy("timezone").agg(F.count(F.lit(1)).alias("store_count"))


def activity_summary(scans: DataFrame) -> DataFrame:
    """Records and JSON volume in characters per time zone."""
    return scans.groupBy("timezone").agg(
        F.count(F.lit(1)).alias("batch_count"),
        F.sum(F.length(scan_json(scans))).alias("data_volume"),
    )


def minute_batches(scans: DataFrame) -> DataFrame:
    """The same per time zone and minute, with the number of voided scans."""
    typed = with_scan_time(scans)
    minute = F.window(F.col("scan_ts"), "1 minute")["start"].alias("minute")
    return typed.groupBy("timezone", minute).agg(
        F.count(F.lit(1)).alias("batch_count"),
        F.count(F.when(F.col("unit_qty") == 0, 1)).alias("void_count"),
        F.sum(F.length(scan_json(scans))).alias("data_volume"),
    )


def running_batches(scans: DataFrame, per_zone: bool = False) -> DataFrame:
    """Minute batches with the cumulative number of records, over all or per time zone.

    The batches are few and used twice, so they are written once; the scans are
    read once.
    """
    batches = staged(minute_batches(scans), "minutes")
    order = ["minute"] if per_zone else ["minute", "timezone"]
    return running_total(
        batches, "batch_count", order, F.col("minute").cast("date"), ["timezone"] if per_zone else []
    )


def scans_messages(batches: DataFrame) -> DataFrame:
    """Minute batches as ``scans`` messages; the minute is taken as UTC."""
    return batches.select(F.to_json(F.struct(
        F.lit("scans").alias("type"),
        F.col("timezone"),
        format_time(F.col("minute")).alias("timestamp"),
        clock_text(utc_to_local(F.col("minute"), F.col("timezone"))).alias("localTime"),
        F.col("batch_count").alias("batchCount"),
        F.col("void_count").alias("voidCount"),
        F.col("data_volume").alias("dataVolume"),
    )).alias("value"))


def read_messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse messages; ``problem`` names lines that are no JSON or of unknown type."""
    broken = "_broken_record"
    schema = T.StructType(ACTIVITY_MESSAGE.fields + [T.StructField(broken, T.StringType())])
    parsed = lines.withColumn("_m", parsed_once(F.from_json(
        F.col(column), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    )))
    malformed = F.col("_m").isNull() | F.col(f"_m.{broken}").isNotNull()
    known = F.coalesce(F.col("_m.type").isin(*MESSAGE_TYPES), F.lit(False))
    problem = F.when(malformed, F.lit("malformed")).when(~known, F.lit("unknown type"))
    kept = [c for c in lines.columns if c not in ACTIVITY_MESSAGE.names]
    fields = [F.col(f"_m.{name}").alias(name) for name in ACTIVITY_MESSAGE.names]
    return parsed.select(*kept, *fields, problem.alias("problem"))


def zone_state(messages: DataFrame, order: Column) -> DataFrame:
    """State of every time zone after all messages.

    A zone exists from its first ``start`` or ``scans`` message on; a ``stop``
    before that is ignored, so it runs unless its last status message is a
    later ``stop``. All of it is minima, maxima and sums, which combine before
    the shuffle: no zone's messages are gathered or replayed in one task.
    """
    kind = F.col("type")
    creates = kind.isin("start", "scans")
    is_scans = kind == "scans"
    summary = messages.groupBy("timezone").agg(
        F.min(F.when(creates, order)).alias("_known"),
        F.max(F.when(kind == "start", order)).alias("_started"),
        F.max(F.when(kind == "stop", order)).alias("_stopped"),
        F.max_by("localTime", F.when(kind.isin(*MESSAGE_TYPES), order)).alias("local_time"),
        F.max_by("timestamp", F.when(is_scans, order)).alias("last_batch_time"),
        F.max_by("batchCount", F.when(is_scans, order)).alias("last_batch_count"),
        F.coalesce(F.sum(F.when(is_scans, F.col("batchCount"))), F.lit(0)).alias("cumulative_count"),
        F.coalesce(F.sum(F.when(is_scans, F.col("dataVolume"))), F.lit(0)).alias("data_volume"),
    )
    return shape_zone_state(summary)


def shape_zone_state(summary: DataFrame) -> DataFrame:
    """Turn the aggregated marks of a zone into its visible state."""
    stopped = F.col("_stopped") > F.greatest(F.col("_known"), F.col("_started"))
    return summary.where(F.col("_known").isNotNull()).select(
        "timezone",
        (~F.coalesce(stopped, F.lit(False))).alias("is_running"),
        "local_time", "last_batch_time", "last_batch_count", "cumulative_count", "data_volume",
    )


def grand_totals(messages: DataFrame) -> DataFrame:
    """Totals over all zones."""
    is_scans = F.col("type") == "scans"
    return messages.where(is_scans).agg(
        F.coalesce(F.sum("batchCount"), F.lit(0)).alias("total_transactions"),
        F.coalesce(F.sum("dataVolume"), F.lit(0)).alias("total_data_volume"),
    )


def centroid(points: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    return points.agg(F.avg(latitude).alias("latitude"), F.avg(longitude).alias("longitude"))
