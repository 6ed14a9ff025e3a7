"""Streams end in the state of the batch query, in any batching and after restarts."""

import json

import pytest
from pyspark.sql import functions as F

from tillhouse.operators.activity import read_messages, zone_state
from tillhouse.schemas import RETAIL_SCANS
from tillhouse.sources.writers import overwrite_table
from tillhouse import jobs
from tillhouse.sources.paths import table_exists
from tillhouse.streaming import ingest, monitor, sources
from tillhouse.streaming.logs import BATCH, compact, read_log


def scan(i, qty, day=1):
    return json.dumps({"scan_id": f"s{i}", "store_id": 1, "scan_datetime": f"2024-01-{day:02d} 10:00:{i % 60:02d}",
                       "item_upc": "u", "unit_qty": qty, "unit_price": 1.5})


def put(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def quantities(df):
    return {r["scan_id"]: r["unit_qty"] for r in df.collect()}


@pytest.mark.parametrize("files_per_batch", [1, 2, 100])
def test_voids_win_in_any_batching(spark, tmp_path, folder, files_per_batch):
    log, checkpoint, arriving = folder("log"), folder("checkpoint"), tmp_path / "in"
    put(arriving, "a.json", [scan(i, 1) for i in range(10)])
    put(arriving, "b.json", [scan(i, 3) for i in range(10, 20)])
    stream = lambda: sources.scan_files(spark, str(arriving), files_per_batch)
    ingest.log_scans(stream(), log, checkpoint).awaitTermination()
    put(arriving, "c.json", [scan(3, 0), scan(12, 0)])
    ingest.log_scans(stream(), log, checkpoint).awaitTermination()  # restart
    put(arriving, "d.json", [scan(3, 0)])  # voided again
    ingest.log_scans(stream(), log, checkpoint).awaitTermination()
    now = quantities(ingest.current_scans(read_log(spark, log, RETAIL_SCANS)))
    assert len(now) == 20 and {k for k, v in now.items() if v == 0} == {"s3", "s12"}


def test_a_repeated_batch_replaces_itself(spark, tmp_path, folder):
    log, arriving = folder("log"), tmp_path / "in"
    put(arriving, "a.json", [scan(i, 1) for i in range(5)])
    for _ in range(2):  # a lost checkpoint makes batch 0 run twice
        ingest.log_scans(sources.scan_files(spark, str(arriving)), log, folder("checkpoint")).awaitTermination()
    assert read_log(spark, log, RETAIL_SCANS).count() == 5


def test_compaction_keeps_the_snapshot(spark, tmp_path, folder):
    log, base, checkpoint, arriving = folder("log"), folder("base"), folder("checkpoint"), tmp_path / "in"
    put(arriving, "a.json", [scan(i, 1, day=1 + i % 3) for i in range(9)])
    ingest.log_scans(sources.scan_files(spark, str(arriving)), log, checkpoint).awaitTermination()
    rows = lambda after=None: ingest.with_scan_day(read_log(spark, log, RETAIL_SCANS, after))
    overwrite_table(rows(), base, ["scan_datestamp"])
    put(arriving, "b.json", [scan(4, 0, day=2), scan(77, 1, day=9)])
    ingest.log_scans(sources.scan_files(spark, str(arriving)), log, checkpoint).awaitTermination()
    expected = quantities(ingest.current_scans(read_log(spark, log, RETAIL_SCANS)))
    for _ in range(2):
        compact(spark, base, rows(0), ["scan_id"], ingest.version_order(), ["scan_datestamp"])
        assert quantities(spark.read.parquet(base)) == expected


def test_append_keeps_all_versions_by_day(spark, tmp_path, folder):
    table, arriving = folder("bronze"), tmp_path / "in"
    put(arriving, "a.json", [scan(1, 1, 1), scan(2, 1, 2), scan(1, 0, 1)])
    ingest.append_scans(sources.scan_files(spark, str(arriving)), table, folder("checkpoint")).awaitTermination()
    stored = spark.read.parquet(table)
    assert stored.count() == 3 and stored.select("scan_datestamp").distinct().count() == 2


def test_bad_lines_go_to_the_rejects(spark, tmp_path, folder):
    good, bad, arriving = folder("good"), folder("bad"), tmp_path / "in"
    lines = [scan(i, 1)[:-6] if i % 50 == 0 else scan(i, 1) for i in range(100)]
    put(arriving, "a.txt", lines)
    stream = sources.line_files(spark, str(arriving))
    ingest.split_stream(stream, good, bad, folder("checkpoint")).awaitTermination()
    assert read_log(spark, good, RETAIL_SCANS).count() == 98
    assert {r["problem"] for r in spark.read.parquet(bad).collect()} == {"malformed"}


def message(seq, zone, kind, count=0):
    return (seq, json.dumps({"type": kind, "timezone": zone, "timestamp": f"t{seq}", "localTime": f"l{seq}",
                             "batchCount": count, "dataVolume": 10 * count}))


MESSAGES = [
    message(1, "A", "stop"), message(2, "A", "scans", 5), message(3, "B", "start"), message(4, "B", "scans", 7),
    message(5, "B", "stop"), message(6, "A", "scans", 6), message(7, "C", "stop"), message(8, "A", "other"), (9, "{broken"),
]


@pytest.mark.parametrize("files", [1, 3, 9])
def test_zone_state_stream_equals_batch(spark, folder, files):
    """Also when messages of one zone arrive in different order and batches."""
    arriving, log = folder("in"), folder("log")
    lines = spark.createDataFrame(MESSAGES[::-1], "seq long, value string")
    lines.repartition(files).write.parquet(arriving)
    stream = sources.table_files(spark, arriving, lines.schema, files_per_batch=1)
    monitor.log_zone_state(stream, F.col("seq"), log, folder("checkpoint")).awaitTermination()
    batch = zone_state(read_messages(lines).where("problem IS NULL"), F.col("seq"))
    final = monitor.current_zone_state(read_log(spark, log, batch.schema))
    assert sorted(map(tuple, final.collect())) == sorted(map(tuple, batch.collect()))
    assert final.count() == 2


def test_minute_counts_update(spark, folder):
    arriving, log = folder("in"), folder("log")
    schema = "scan_ts timestamp_ntz, timezone string, unit_qty int"
    scans = spark.createDataFrame([("Z", i % 3, i) for i in range(240)], "timezone string, unit_qty int, i int").select(
        F.timestamp_add("SECOND", F.col("i"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")).alias("scan_ts"), "timezone", "unit_qty")
    scans.repartition(4).write.parquet(arriving)
    stream = sources.table_files(spark, arriving, scans.schema, files_per_batch=1)
    monitor.log_minute_counts(stream, log, folder("checkpoint")).awaitTermination()
    counts = monitor.current_minute_counts(read_log(spark, log, monitor.minute_counts(scans).schema))
    assert sorted(r["scans"] for r in counts.collect()) == [60, 60, 60, 60]
    assert counts.agg(F.sum("voids")).first()[0] == 80 and schema


def test_late_scans_count(spark, folder):
    """Files far apart in time and out of order, one for each batch."""
    arriving, log = folder("in"), folder("log")
    for day in (62, 1, 40, 2):
        one = spark.createDataFrame([("Z", 1)], "timezone string, unit_qty int").withColumn(
            "scan_ts", F.timestamp_add("DAY", F.lit(day), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")))
        one.coalesce(1).write.mode("append").parquet(arriving)
    monitor.log_minute_counts(sources.table_files(spark, arriving, one.schema, files_per_batch=1), log, folder("checkpoint")).awaitTermination()
    counts = monitor.current_minute_counts(read_log(spark, log, monitor.minute_counts(one).schema))
    assert [r["scans"] for r in counts.collect()] == [1] * 4


def test_folded_batches_are_dropped(spark, tmp_path, folder):
    log, table, checkpoint, arriving = folder("log"), folder("bronze"), folder("checkpoint"), tmp_path / "in"
    put(arriving, "a.json", [scan(i, 1, day=1 + i % 3) for i in range(9)])
    for name, lines in (("b.json", [scan(77, 1, day=9)]), ("c.json", [scan(4, 0, day=2)])):
        jobs.main(["ingest", "--arriving", str(arriving), "--log", log, "--checkpoint", checkpoint])
        jobs.main(["compact", "--log", log, "--table", table])
        assert not table_exists(spark, log)
        put(arriving, name, lines)
    jobs.main(["ingest", "--arriving", str(arriving), "--log", log, "--checkpoint", checkpoint])
    jobs.main(["compact", "--log", log, "--table", table])
    assert quantities(spark.read.parquet(table)) == {f"s{i}": int(i != 4) for i in range(9)} | {"s77": 1}


def test_duplicates_at_any_distance(spark, folder):
    arriving, log = folder("in"), folder("log")
    rows = [("a", 1, "2024-01-01 10:00:00"), ("a", 1, "2024-05-01 10:00:00"), ("a", 0, "2024-01-01 10:00:00"), ("b", 1, "2024-01-01 10:01:00")]
    scans = spark.createDataFrame(rows, "scan_id string, unit_qty int, t string").select(
        "scan_id", "unit_qty", F.col("t").cast("timestamp_ntz").alias("scan_ts"))
    scans.repartition(4).write.parquet(arriving)
    stream = sources.table_files(spark, arriving, scans.schema, files_per_batch=1)
    ingest.log_distinct_scans(stream, log, folder("checkpoint")).awaitTermination()
    once = ingest.distinct_scans(read_log(spark, log, scans.schema))
    assert sorted((r["scan_id"], r["unit_qty"]) for r in once.collect()) == [("a", 0), ("a", 1), ("b", 1)]


def test_item_changes(spark, folder):
    arriving, log, checkpoint = folder("in"), folder("log"), folder("checkpoint")
    items = spark.createDataFrame([(1, "x", 10), (2, "y", 20)], "item_id int, upc_code string, base_price int")
    schema = "item_id int, op string, base_price int, seq int"
    for wave in ([(1, "U", 11, 1), (3, "I", 30, 2)], [(2, "D", None, 3), (1, "U", 12, 4)]):
        spark.createDataFrame(wave, schema).write.mode("append").parquet(arriving)
        stream = sources.table_files(spark, arriving, spark.createDataFrame([], schema).schema)
        ingest.log_item_changes(stream, log, checkpoint).awaitTermination()
    changed = ingest.current_items(items, read_log(spark, log, spark.createDataFrame([], schema).schema))
    assert {tuple(r) for r in changed.collect()} == {(1, "x", 12), (3, None, 30)}
    assert BATCH not in changed.columns


def test_topic_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.topic(spark, "localhost:1", "retail_scans")
