"""Streams over files that Spark writes from the test tables, and their final state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.records import scan_json
from tillhouse.operators.activity import read_messages
from tillhouse.registry.activity import ZONE_STATE, ZONE_STATE_SQL, message_lines
from tillhouse.registry.core import query
from tillhouse.registry.tables import scan_lines
from tillhouse.schemas import RETAIL_SCANS
from tillhouse.session import new_folder, staged
from tillhouse.sources import retail_views as rv
from tillhouse.sources.paths import exists
from tillhouse.sources.readers import read_table
from tillhouse.streaming import ingest, monitor, sources, zones
from tillhouse.streaming.logs import read_log, write_log

LINES = T.StructType().add("seq", "string").add("value", "string")
MESSAGES = T.StructType().add("seq", "long").add("value", "string")
BATCHES = 4  # at least
LEAST_FILES = 8


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows out of order, in as many files as the input has partitions, and some at least."""
    return rows.repartition(max(LEAST_FILES, rows.rdd.getNumPartitions()))


def _files(spark: SparkSession, path: str) -> int:
    return len(spark.read.format("binaryFile").load(path).inputFiles())


def _per_batch(spark: SparkSession, path: str) -> int:
    return max(1, _files(spark, path) // BATCHES)


def _write_scans(scans: DataFrame, path: str) -> None:
    """Scans as JSON files, one object per line."""
    _dealt(scans.select(scan_json(scans).alias("value"))).write.mode("append").text(path)


def _write_rows(rows: DataFrame, label: str) -> str:
    path = new_folder(rows.sparkSession, label)
    _dealt(rows).write.parquet(path)
    return path


def _stream(spark: SparkSession, rows: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    path = _write_rows(rows, "arriving")
    return sources.table_files(spark, path, schema or rows.schema, _per_batch(spark, path))


_SCAN = "scan_id text, store_id bigint, scan_datetime text, item_upc text, unit_qty bigint, unit_price double"


@query(_SCAN, "SELECT * FROM timed_scans", ["timed_scans"])
def stream_ingest(spark, sf):
    """Arriving scans appended to a table partitioned by day."""
    arriving, table, checkpoint = (new_folder(spark, n) for n in ("arriving", "bronze", "checkpoint"))
    _write_scans(rv.timed_scans(spark, sf), arriving)
    stream = sources.scan_files(spark, arriving, _per_batch(spark, arriving))
    ingest.append_scans(stream, table, checkpoint).awaitTermination()
    return read_table(spark, table)


@query(_SCAN, "SELECT * FROM timed_scans", ["timed_scans"])
def stream_upsert_final(spark, sf):
    """Sales first, their voids in a second run from the same checkpoint."""
    arriving, log, checkpoint = (new_folder(spark, n) for n in ("arriving", "log", "checkpoint"))
    waves = rv.timed_scans(spark, sf, voided=False), rv.timed_scans(spark, sf).where("unit_qty = 0")
    for wave in waves:
        _write_scans(wave, arriving)
        stream = sources.scan_files(spark, arriving, _per_batch(spark, arriving))
        ingest.log_scans(stream, log, checkpoint).awaitTermination()
    return ingest.current_scans(read_log(spark, log, RETAIL_SCANS))


@query(
    "minute text, timezone text, scans bigint, voids bigint, units bigint",
    "SELECT minute, timezone, batch_count AS scans, void_count AS voids, units FROM minutes", ["minutes"],
)
def stream_minute_counts(spark, sf):
    scans = rv.timed_scans(spark, sf).select("scan_ts", "timezone", "unit_qty")
    log, checkpoint = new_folder(spark, "minutes"), new_folder(spark, "checkpoint")
    monitor.log_minute_counts(_stream(spark, scans), log, checkpoint).awaitTermination()
    schema = monitor.minute_counts(scans).schema
    return monitor.current_minute_counts(read_log(spark, log, schema))


@query(ZONE_STATE, ZONE_STATE_SQL, ["good_messages"])
def stream_zone_state(spark, sf):
    messages = message_lines(spark, sf)
    log, checkpoint = new_folder(spark, "zones"), new_folder(spark, "checkpoint")
    stream = _stream(spark, messages, MESSAGES)
    order = F.col("seq")
    monitor.log_zone_state(stream, order, log, checkpoint).awaitTermination()
    schema = monitor.zone_state(read_messages(messages), order).schema
    return monitor.current_zone_state(read_log(spark, log, schema))


@query(
    "seq bigint, problem text",
    """SELECT seq, CASE WHEN torn THEN 'malformed' ELSE 'unknown type' END AS problem
       FROM messages WHERE torn OR type = 'heartbeat'""",
    ["messages"],
)
def stream_rejects(spark, sf):
    """Messages that cannot be read or are of unknown type, kept aside."""
    log, checkpoint = new_folder(spark, "rejects"), new_folder(spark, "checkpoint")
    stream = _stream(spark, message_lines(spark, sf), MESSAGES)
    rejected = read_messages(stream).where(F.col("problem").isNotNull()).select("seq", "problem")
    write_log(rejected, log, checkpoint).awaitTermination()
    return read_log(spark, log, rejected.schema)


@query(
    "seq text, problem text, unit_price double",
    """SELECT scan_id AS seq, CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'missing unit_price'
                              WHEN 'purchase' THEN 'negative quantity' END AS problem,
              CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN NULL ELSE unit_price END AS unit_price
       FROM timed_scans""",
    ["timed_scans"],
)
def stream_contract_split(spark, sf):
    """One stream of lines into good scans and rejected lines."""
    good, bad, checkpoint = (new_folder(spark, n) for n in ("good", "bad", "checkpoint"))
    ingest.split_stream(_stream(spark, scan_lines(spark, sf), LINES), good, bad, checkpoint).awaitTermination()
    scans = read_log(spark, good, RETAIL_SCANS)
    rejected = read_log(spark, bad, T.StructType([*LINES.fields]).add("problem", "string"))
    nothing = F.lit(None)
    return scans.select(F.col("scan_id").alias("seq"), nothing.cast("string").alias("problem"), "unit_price").unionByName(
        rejected.select("seq", "problem", nothing.cast("decimal(8,2)").alias("unit_price"))
    )


@query(
    "item_id bigint, upc_code text, category_code bigint, base_price double", "SELECT * FROM changed_items",
    ["changed_items"],
)
def stream_item_changes(spark, sf):
    """The item change feed as a stream, applied to the item master on reading."""
    changes = rv.item_changes(spark, sf)
    log, checkpoint = new_folder(spark, "item_log"), new_folder(spark, "checkpoint")
    ingest.log_item_changes(_stream(spark, changes), log, checkpoint).awaitTermination()
    return ingest.current_items(rv.items(spark, sf), read_log(spark, log, changes.schema))


@query(
    "timezone text, scans bigint",
    "SELECT timezone, count(*) AS scans FROM timed_scans GROUP BY ALL", ["timed_scans"],
)
def stream_distinct_scans(spark, sf):
    """Every scan arrives twice and is counted once."""
    scans = rv.timed_scans(spark, sf).select("scan_id", "unit_qty", "scan_ts", "timezone")
    log, checkpoint = new_folder(spark, "distinct"), new_folder(spark, "checkpoint")
    ingest.log_distinct_scans(_stream(spark, scans.unionByName(scans)), log, checkpoint).awaitTermination()
    once = ingest.distinct_scans(read_log(spark, log, scans.schema))
    return once.groupBy("timezone").agg(F.count(F.lit(1)).alias("scans"))


DELAY = "6 hours"


FILE_ROWS = 250_000  # at most, about


def _by_time(rows: DataFrame, parts: int, late: Column, time: str = "scan_ts", path: str | None = None) -> tuple[str, int]:
    """Rows in ``parts`` stretches of time, written in order; ``late`` rows come in the last one.

    Every stretch has the same number of files, some of them perhaps empty, so that many files a batch make one stretch.
    The number grows with the rows, which are written once and then dealt where they lie: no task holds a stretch.
    """
    rows = staged(rows, "rows")
    spark, path = rows.sparkSession, path or new_folder(rows.sparkSession, "arriving")
    lo, hi = rows.agg(F.min(time), F.max(time)).first()
    step = (hi - lo) / parts
    stretches = []
    for i in range(parts):
        until = F.lit(True) if i == parts - 1 else F.col(time) < F.lit(lo + (i + 1) * step)
        stretch = (F.col(time) >= F.lit(lo + i * step)) & until
        stretches.append(stretch & ~late | late if i == parts - 1 else stretch & ~late)
    most = max(rows.agg(*[F.count_if(s).alias(f"_{i}") for i, s in enumerate(stretches)]).first())
    files = max(1, -(-most // FILE_ROWS))
    there = _files(spark, path) if exists(spark, path) else 0
    for stretch in stretches:
        rows.where(stretch).coalesce(files).write.mode("append").parquet(path)
        for _ in range(there + files - _files(spark, path)):
            spark.createDataFrame([], rows.schema).write.mode("append").parquet(path)
        there += files
    return path, files


@query(
    "scan_id text, unit_qty bigint, scan_ts text, copies bigint",
    """SELECT scan_id, unit_qty, scan_ts, CASE WHEN event_type = 'purchase' AND scan_ts < TIMESTAMP '2024-01-11' THEN 2 ELSE 1 END AS copies
       FROM timed_scans""",
    ["timed_scans"],
)
def stream_distinct_within(spark, sf):
    """Every scan is sent twice within the delay, and some once more 19 days later, which is beyond it.

    Those 19 days apart count as new scans, the others once, with a state that holds the scans of the delay only.
    """
    scans = rv.timed_scans(spark, sf).select("scan_id", "unit_qty", "scan_ts")
    again = rv.table(spark, sf, "events").where("event_type = 'purchase' AND ts < '2024-01-11'").select(
        F.col("event_id").cast("string").alias("scan_id"), F.lit(1).alias("unit_qty"), F.timestamp_add("DAY", F.lit(19), F.col("ts")).alias("scan_ts"))
    path, files = _by_time(scans.unionByName(scans).unionByName(again), 6, F.lit(False))
    log, checkpoint = new_folder(spark, "distinct"), new_folder(spark, "checkpoint")
    stream = sources.table_files(spark, path, scans.schema, files)
    ingest.log_distinct_within(stream, log, checkpoint, DELAY).awaitTermination()
    return read_log(spark, log, scans.schema).groupBy("scan_id", "unit_qty").agg(
        F.min("scan_ts").alias("scan_ts"), F.count(F.lit(1)).alias("copies"))


@query(
    "minute text, timezone text, scans bigint, on_time bigint, late bigint",
    """SELECT minute, timezone, count(*) AS scans, count(*) FILTER (NOT late) AS on_time, count(*) FILTER (late) AS late
       FROM (SELECT date_trunc('minute', scan_ts) AS minute, timezone,
                    event_type = 'error' AND date_trunc('minute', scan_ts) + INTERVAL 1 MINUTE <= (
                        SELECT max(scan_ts) - INTERVAL 6 HOUR FROM timed_scans
                        WHERE event_type <> 'error' AND scan_ts < (SELECT min(scan_ts) + 3 * ((max(scan_ts) - min(scan_ts)) / 5) FROM timed_scans)
                    ) AS late FROM timed_scans)
       WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(scan_ts) - INTERVAL 6 HOUR FROM timed_scans)
       GROUP BY ALL""",
    ["timed_scans"],
)
def stream_minute_rate(spark, sf):
    """Closed minutes with the scans that were in time for them and those that came late: voids arrive at the end.

    A micro-batch takes scans by the watermark that the batch before it began with, so the last of five stretches is held
    against the first three. All counts are folded; what is read is a row a minute and zone.
    """
    scans = rv.timed_scans(spark, sf).select("scan_ts", "timezone", "unit_qty")
    path, files = _by_time(scans, 5, F.col("unit_qty") == 0)
    log, table, closed, marks, more = (new_folder(spark, n) for n in ("minutes", "counts", "closed", "checkpoint", "checkpoint"))
    stream = lambda: sources.table_files(spark, path, scans.schema, files)
    monitor.log_closed_minutes(stream(), closed, marks, DELAY).awaitTermination()
    monitor.log_minutes_by_day(stream(), log, more).awaitTermination()
    monitor.fold_minute_counts(spark, log, table)
    counts = monitor.read_minute_counts(spark, table, log)
    on_time = read_log(spark, closed, monitor.closed_minutes(scans, DELAY).schema).drop("_batch")
    late = monitor.late_counts(on_time, counts)
    met = counts.join(on_time, monitor.MINUTE_KEY, "left").join(late, monitor.MINUTE_KEY, "left")
    nothing = F.lit(0)
    return met.where(F.coalesce("on_time", "late").isNotNull()).select(
        *monitor.MINUTE_KEY, "scans", F.coalesce("on_time", nothing).alias("on_time"), F.coalesce("late", nothing).alias("late"))


_LOST = "timezone IN ('AKST (GMT-09)', 'HST (GMT-10)') AND ts >= '2024-01-20'"


@query(
    ZONE_STATE + ", is_silent boolean",
    f"""SELECT z.*, s.is_silent FROM ({ZONE_STATE_SQL.replace("good_messages", "heard")}) z JOIN (
            SELECT timezone, max(stamp) < (SELECT strftime(max(CAST(stamp AS TIMESTAMP)) - INTERVAL 18 HOUR, '%Y-%m-%d %H:%M:%S') FROM heard)
                   AS is_silent FROM heard GROUP BY timezone) s ON z.timezone = s.timezone""",
    ["heard"],
)
def stream_zone_processor(spark, sf):
    """Zone state by a processor with state and timers, restarted half-way; two zones are lost on the way."""
    lines = message_lines(spark, sf).join(rv.timed_scans(spark, sf).select(
        F.col("scan_id").cast("bigint").alias("seq"), F.col("scan_ts").alias("ts"), "timezone"), "seq")
    heard = lines.where(f"NOT ({_LOST})").select("seq", "value", "ts")
    path, log, checkpoint = (new_folder(spark, n) for n in ("arriving", "zones", "checkpoint"))
    half = F.lit(dt.datetime(2024, 1, 16)).cast("timestamp_ntz")
    for wave in (heard.where(F.col("ts") < half), heard.where(F.col("ts") >= half)):
        _, files = _by_time(wave, 2, F.lit(False), "ts", path)
        stream = sources.table_files(spark, path, MESSAGES, files)
        zones.log_zone_marks(stream, F.col("seq"), log, checkpoint, DELAY, dt.timedelta(hours=12)).awaitTermination()
    return zones.current_zones(read_log(spark, log, zones.STATE))
