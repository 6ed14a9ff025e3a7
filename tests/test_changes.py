"""Rollups by signed changes, folded feeds and minutes, the zone processor, and what the jobs read."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillhouse import jobs
from tillhouse.operators import promotions, sampling
from tillhouse.operators.activity import read_messages, zone_state
from tillhouse.operators.promotions import best_prices, day_number, dyadic_pieces
from tillhouse.operators.versions import apply_changes
from tillhouse.plans import rollups, silver
from tillhouse.registry import sales, streams
from tillhouse.sources.paths import table_exists
from tillhouse.sources.writers import write_partitioned
from tillhouse.streaming import changes, ingest, monitor, sources, sums, zones
from tillhouse.streaming.logs import BATCH, read_log, store_batch, write_log

DETAIL = ("scan_id string, store_id int, scan_timestamp timestamp_ntz, scan_datestamp date, item_upc string, unit_qty int, unit_price decimal(8,2), "
          "net_sale decimal(10,2), item_id int, category_code int, category_name string, city string, state string, region string")


def detail(spark, *scans):
    """Scans as (id, day, store, quantity, price) of one item a store."""
    rows = []
    for i, day, store, qty, price in scans:
        time = dt.datetime.fromisoformat(f"{day} 10:00:00") if day else None
        sale = None if price is None or qty is None else Decimal(price) * qty
        rows.append((i, store, time, time and time.date(), f"u{store}", qty, price and Decimal(price), sale, store, 10 * store, f"c{store}", "x", "y", "r"))
    return spark.createDataFrame(rows, DETAIL)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_as_rebuilt(spark, path):
    now = spark.read.parquet(f"{path}/sales_detail")
    for name, build in (("sales_by_day", silver.sales_by_day), ("sales_by_month", silver.sales_by_month)):
        built = build(now)
        assert rows(rollups.read_rollup(spark, path, name).select(built.columns)) == rows(built)


def test_signed_changes_equal_a_rebuild(spark, folder, monkeypatch):
    path = folder("silver")
    first = detail(spark, ("a", "2024-01-31", 1, 2, "1.50"), ("b", "2024-01-31", 2, 3, "2.00"), ("c", "2024-02-01", 1, 1, None),
                   ("d", "2024-02-01", 2, None, "2.00"), ("e", None, 1, 1, "1.00"), ("f", "2023-12-31", 2, 5, "2.00"))
    write_partitioned(first, f"{path}/sales_detail", ["scan_datestamp"])
    rollups.create_rollups(spark, path)
    same_as_rebuilt(spark, path)
    # A void, a sale without a price that gets one, a new day, another region of one scan, a repeated version.
    wave = detail(spark, ("a", "2024-01-31", 1, 0, "1.50"), ("c", "2024-02-01", 1, 1, "4.00"), ("g", "2024-03-05", 2, 1, "2.00"),
                  ("f", "2023-12-31", 1, 5, "2.00"), ("b", "2024-01-31", 2, 3, "2.00"), ("e", None, 1, 0, "1.00"))
    real = rollups.upsert_table
    monkeypatch.setattr(rollups, "upsert_table", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):  # the differences are logged, the details not yet changed
        rollups.record_changes(spark, path, wave, 0)
    monkeypatch.setattr(rollups, "upsert_table", real)
    rollups.record_changes(spark, path, wave, 0)
    same_as_rebuilt(spark, path)
    assert rollups.last_recorded(spark, path) == 0
    drop = sums.drop_batches
    monkeypatch.setattr(sums, "drop_batches", lambda *a: None)  # lost before the folded batches are dropped
    rollups.fold_rollups(spark, path)
    monkeypatch.setattr(sums, "drop_batches", drop)
    same_as_rebuilt(spark, path)
    rollups.record_changes(spark, path, wave, 0)  # again: nothing changes
    rollups.record_changes(spark, path, detail(spark, ("g", "2024-03-05", 2, 0, "2.00"), ("h", "2024-01-31", 1, 7, "1.00")), 1)
    same_as_rebuilt(spark, path)
    for _ in range(2):
        rollups.fold_rollups(spark, path)
        same_as_rebuilt(spark, path)
    assert not table_exists(spark, f"{path}/rollups/sales_by_day_changes")
    assert rollups.last_recorded(spark, path) == 1


def test_late_changes_read_their_days_only(spark, folder):
    path = folder("silver")
    write_partitioned(detail(spark, *[(f"s{i}", f"2024-01-{i:02d}", 1, 1, "1.00") for i in range(1, 29)]), path, ["scan_datestamp"])
    new = detail(spark, ("s3", "2024-01-03", 1, 0, "1.00"))
    images = rollups.signed_images(spark.read.parquet(path), new, [dt.date(2024, 1, 3)])
    plan = images._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scan_datestamp" in plan and "2024-01-03" in plan
    assert rows(images.select("scan_id", "unit_qty", "_sign")) == [("s3", 0, 1), ("s3", 1, -1)]


def test_jobs_prune_before_they_take_versions(spark, folder):
    table = folder("bronze")
    scans = spark.range(100).select(
        F.concat(F.lit("s"), "id").alias("scan_id"), F.lit(1).alias("store_id"),
        F.format_string("2024-01-%02d 10:00:00", F.col("id") % 28 + 1).alias("scan_datetime"), F.lit("u").alias("item_upc"),
        F.lit(1).alias("unit_qty"), F.lit(1).cast("decimal(8,2)").alias("unit_price"))
    write_partitioned(ingest.with_scan_day(scans), table, ["scan_datestamp"])
    from tillhouse.operators.versions import current_scans

    pruned = current_scans(jobs.scans_of_days(spark.read.parquet(table), dt.date(2024, 1, 5), dt.date(2024, 1, 6)))
    files = {f.split("scan_datestamp=")[1][:10] for f in pruned.select(F.input_file_name()).inputFiles() if "scan_datestamp" in f}
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scan_datestamp" in plan and files
    out = folder("deltas")
    jobs.main(["inventory", "--scans", table, "--table", out, "--run-date", "2024-01-06"])
    assert rows(spark.read.parquet(out).select("store_id", "item_upc", "net_quantity_delta")) == [(1, "u", 4)]


ITEM = "item_id int, upc_code string, base_price int"
CHANGE = "item_id int, op string, base_price int, seq int"


def feed_of(spark, buckets=3):
    empty = lambda s: spark.createDataFrame([], s).schema
    return changes.Feed(empty(ITEM), empty(CHANGE), ("item_id",), ("seq",), buckets=buckets)


WAVES = [
    [(1, "U", 11, 1), (3, "I", 30, 2), (2, "D", None, 3), (5, "D", None, 9)],
    [(2, "U", 7, 2), (1, "U", 12, 4), (5, "U", 50, 8), (4, "D", None, 1)],  # older changes of 2 and 5 arrive late
    [(4, "I", 44, 2), (6, "D", None, 1), (1, "D", None, 0)],
    [(3, "D", None, 7), (4, "D", None, 8)],  # deletes only
]


def test_folded_feed_equals_the_changes_applied(spark, folder):
    feed, table, log = feed_of(spark), folder("items"), folder("log")
    items = spark.createDataFrame([(i, f"x{i}", 10 * i) for i in (1, 2, 4, 5, 7)], ITEM)
    changes.create_table(items, table, feed)
    seen = []
    for number, wave in enumerate(WAVES):
        seen += [(*c, number) for c in wave]
        store_batch(spark.createDataFrame(wave, CHANGE), number, log)
        whole = spark.createDataFrame(seen, CHANGE + f", {BATCH} long")
        expected = rows(apply_changes(items, whole, ["item_id"], [F.col("seq"), F.col(BATCH)]))
        assert rows(changes.read_with_log(spark, table, log, feed)) == expected
        if number != 1:  # two batches are folded together
            kept = spark.read.parquet(log).drop(BATCH).collect()
            changes.fold(spark, table, log, feed)
            assert not table_exists(spark, log)
            assert rows(changes.read_table(spark, table, feed)) == expected
            store_batch(spark.createDataFrame(kept, CHANGE), number, log)  # folded, but not dropped: once more
            changes.fold(spark, table, log, feed)
            assert rows(changes.read_table(spark, table, feed)) == expected


def test_tombstones_go_with_time(spark, folder):
    feed, table, log = feed_of(spark, 1), folder("items"), folder("log")
    changes.create_table(spark.createDataFrame([(1, "x", 1)], ITEM), table, feed)
    for number, wave in enumerate(([(1, "D", None, 1)], [(9, "D", None, 1)], [(8, "D", None, 1)])):
        store_batch(spark.createDataFrame(wave, CHANGE), number, log)
        changes.fold(spark, table, log, feed, keep_tombstones=2)
    assert [r.item_id for r in changes.read_stored(spark, table, feed).orderBy("item_id").collect()] == [8, 9]
    store_batch(spark.createDataFrame([(7, "D", None, 1)], CHANGE), 3, log)
    changes.fold(spark, table, log, feed, keep_tombstones=0)  # the only bucket is left without rows
    assert changes.read_table(spark, table, feed).count() == 0 and changes.read_stored(spark, table, feed).count() == 0


def test_item_jobs(spark, tmp_path, folder):
    items, table, log, checkpoint = folder("master"), folder("items"), folder("log"), folder("checkpoint")
    spark.createDataFrame([(10, 1, Decimal("1"), "a", 1, 1), (10, 2, Decimal("2"), "b", 1, 1)], jobs.ITEM_MASTER).write.parquet(items)
    (tmp_path / "in").mkdir()
    for name, wave in (("a", [{"item_id": 1, "op": "D", "seq": 5}]), ("b", [{"item_id": 1, "op": "U", "base_price": 9, "seq": 4},
                                                                            {"item_id": 2, "op": "U", "base_price": 3.5, "seq": 1}])):
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(map(json.dumps, wave)) + "\n")
        jobs.main(["ingest-items", "--arriving", str(tmp_path / "in"), "--log", log, "--checkpoint", checkpoint])
        jobs.main(["fold-items", "--items", items, "--log", log, "--table", table])
    assert [(r.item_id, r.base_price, r.upc_code) for r in changes.read_table(spark, table, jobs.ITEMS).collect()] == [(2, Decimal("3.50"), "b")]


def test_rollup_and_monitor_jobs(spark, tmp_path, folder):
    bronze, lake, log, checkpoint, arriving = folder("bronze"), folder("silver"), folder("log"), folder("checkpoint"), tmp_path / "in"
    spark.createDataFrame([(1, "LA", "CA", "WEST", "PST (GMT-08)")], "store_id int, city string, state string, region string, timezone string").write.parquet(f"{bronze}/retail_stores")
    spark.createDataFrame([(10, 1, Decimal("1"), "u", 1, 1)], jobs.ITEM_MASTER).write.parquet(f"{bronze}/retail_item_master")
    spark.createDataFrame([(10, "Food")], "category_code int, category_name string").write.parquet(f"{bronze}/retail_item_categories")
    line = lambda i, qty, day: json.dumps({"scan_id": f"s{i}", "store_id": 1, "scan_datetime": f"2024-01-{day:02d} 10:00:00",
                                           "item_upc": "u", "unit_qty": qty, "unit_price": 1.5})
    arriving.mkdir()

    def arrive(name, lines):
        (arriving / name).write_text("\n".join(lines) + "\n")
        jobs.main(["ingest", "--arriving", str(arriving), "--log", log, "--checkpoint", checkpoint])

    scans = ingest.with_scan_day(spark.read.schema(jobs.RETAIL_SCANS).json(spark.sparkContext.parallelize([line(i, 1, i) for i in range(1, 9)])))
    write_partitioned(scans, f"{bronze}/retail_scans", ["scan_datestamp"])
    jobs.main(["silver", "--bronze", bronze, "--silver", lake, "--full"])
    command = ["rollups", "--bronze", bronze, "--silver", lake, "--log", log]
    for name, lines in (("a", [line(3, 0, 3)]), ("b", [line(20, 4, 20), line(5, 0, 5)])):
        arrive(f"{name}.json", lines)
        jobs.main(command)
        jobs.main(command)
        same_as_rebuilt(spark, lake)
    days = {r.scan_date.day: r.net_units for r in rollups.read_rollup(spark, lake, "sales_by_day").collect()}
    assert days == {1: 1, 2: 1, 3: 0, 4: 1, 5: 0, 6: 1, 7: 1, 8: 1, 20: 4}
    jobs.main(["monitor", "--arriving", str(arriving), "--stores", f"{bronze}/retail_stores", "--counts", f"{lake}/activity", "--checkpoint", f"{checkpoint}2"])
    counts = monitor.read_minute_counts(spark, f"{lake}/activity/minutes", f"{lake}/activity/log")
    assert counts.agg(F.sum("scans")).first()[0] == 3


def times(spark, seconds):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.createDataFrame([(f"s{i}", 1, "Z", s) for i, s in enumerate(seconds)], "scan_id string, unit_qty int, timezone string, s int").select(
        "scan_id", "unit_qty", "timezone", F.timestamp_add("SECOND", F.col("s"), start).alias("scan_ts"))


def test_duplicates_within_a_delay_keep_little_state(spark, folder):
    arriving, log = folder("in"), folder("log")
    scans = times(spark, range(0, 36000, 10))
    for hour in range(10):
        part = scans.where(F.hour("scan_ts") == hour)
        part.unionByName(part).coalesce(1).write.mode("append").parquet(arriving)
    stream = sources.table_files(spark, arriving, scans.schema, files_per_batch=1)
    run = ingest.log_distinct_within(stream, log, folder("checkpoint"), "10 minutes")
    run.awaitTermination()
    kept = max(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"])
    assert read_log(spark, log, scans.schema).count() == 3600
    assert kept <= 2 * 360 + 60  # two files and the delay, of 3600 scans


def test_late_scans_are_counted_beside_the_closed_minutes(spark, folder):
    arriving, log, table, closed = folder("in"), folder("log"), folder("table"), folder("closed")
    for wave in ([0, 30, 90], [7200], [14400], [5, 61, 14430], [21600]):
        times(spark, wave).coalesce(1).write.mode("append").parquet(arriving)
        stream = lambda: sources.table_files(spark, arriving, times(spark, [0]).schema, files_per_batch=1)
    monitor.log_closed_minutes(stream(), closed, folder("checkpoint"), "10 minutes").awaitTermination()
    checkpoint = folder("checkpoint")
    monitor.log_minutes_by_day(stream(), log, checkpoint).awaitTermination()
    for _ in range(2):
        monitor.fold_minute_counts(spark, log, table)
        counts = monitor.read_minute_counts(spark, table, log)
        assert {(r.minute.hour, r.minute.minute): r.scans for r in counts.collect()} == {(0, 0): 3, (0, 1): 2, (2, 0): 1, (4, 0): 2, (6, 0): 1}
    on_time = read_log(spark, closed, monitor.closed_minutes(times(spark, [0]), "10 minutes").schema)
    assert {(r.minute.hour, r.minute.minute): r.on_time for r in on_time.collect()} == {(0, 0): 2, (0, 1): 1, (2, 0): 1, (4, 0): 2}
    late = monitor.late_counts(on_time.drop(BATCH), counts)
    assert {(r.minute.hour, r.minute.minute): r.late for r in late.collect()} == {(0, 0): 1, (0, 1): 1}
    assert counts.inputFiles() and len(counts.inputFiles()) <= 8  # however many micro-batches there were
    times(spark, [10]).coalesce(1).write.mode("append").parquet(arriving)
    monitor.log_minutes_by_day(stream(), log, checkpoint).awaitTermination()
    assert {r.scans for r in monitor.read_minute_counts(spark, table, log).where("minute = '2024-01-01 00:00:00'").collect()} == {4}


def test_zone_processor_in_any_order_and_after_a_restart(spark, folder):
    def message(seq, zone, kind, minute, count=0):
        stamp = f"2024-01-01 10:{minute:02d}:00"
        return seq, json.dumps({"type": kind, "timezone": zone, "timestamp": stamp, "localTime": stamp[11:], "batchCount": count, "dataVolume": 10 * count})

    waves = [
        [message(2, "A", "scans", 1, 5), message(1, "A", "stop", 0), message(3, "B", "start", 1), message(7, "C", "stop", 2), (9, "{broken")],
        [message(6, "A", "scans", 6, 6), message(5, "B", "stop", 5), message(4, "B", "scans", 4, 7), message(8, "A", "other", 6)],
        [message(10, "A", "scans", 50, 1)],
    ]
    arriving, log, checkpoint = folder("in"), folder("log"), folder("checkpoint")
    lines = spark.createDataFrame([m for w in waves for m in w], "seq long, value string")
    for wave in waves:
        spark.createDataFrame(wave, lines.schema).coalesce(1).write.mode("append").parquet(arriving)
        stream = sources.table_files(spark, arriving, lines.schema, files_per_batch=1)
        zones.log_zone_marks(stream, F.col("seq"), log, checkpoint, "10 minutes", dt.timedelta(minutes=20)).awaitTermination()
    now = zones.current_zones(read_log(spark, log, zones.STATE))
    batch = zone_state(read_messages(lines).where("problem IS NULL"), F.col("seq"))
    assert rows(now.drop("is_silent")) == rows(batch)
    assert {r.timezone: r.is_silent for r in now.collect()} == {"A": False, "B": True}


def test_samples_do_not_depend_on_the_layout(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("g"))
    drawn = [rows(sampling.random_rows(df.repartition(n), 25, 1)) for n in (1, 32)]
    assert drawn[0] == drawn[1] and len(drawn[0]) == 25
    per_group = [rows(sampling.random_rows_per_group(df.repartition(n), ["g"], 5, 1, F.col("id"))) for n in (1, 32)]
    assert per_group[0] == per_group[1] and len(per_group[0]) == 35
    parts = [sampling.random_rows(df.where(c), 25, 1, F.col("id")) for c in ("id < 400", "id >= 400")]
    assert rows(sampling.merge_samples(parts, 25, 1, F.col("id"))) == rows(sampling.random_rows(df, 25, 1, F.col("id")))
    assert rows(sampling.coin_sample(df.repartition(9), 0.2, 3, F.col("id"))) == rows(sampling.coin_sample(df, 0.2, 3, F.col("id")))


@pytest.mark.parametrize("first, last", [("2024-01-01", "2024-01-01"), ("2024-01-03", "2024-03-17"), ("1999-12-31", "2031-01-01"), ("0001-01-01", "9999-12-31"), ("2024-02-01", "2024-01-01")])
def test_pieces_cover_a_range_once(spark, first, last):
    found = dyadic_pieces(spark.sql(f"SELECT DATE '{first}' AS a, DATE '{last}' AS b"), "a", "b").select("level", "piece").collect()
    days = [d for r in found for d in (r.piece << r.level, (r.piece + 1) << r.level)]
    spans = sorted(zip(days[::2], days[1::2]))
    lo, hi = spark.sql(f"SELECT DATE '{first}' AS a, DATE '{last}' AS b").select(day_number(F.col("a")), day_number(F.col("b"))).first()
    assert len(found) <= 44
    if lo > hi:
        assert not found
    else:
        assert spans[0][0] == lo and spans[-1][1] == hi + 1 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_open_ended_promotions(spark):
    schema = "start_date date, end_date date, discount_type string, discount_value decimal(10,2), region string, category_code int, item_id int"
    day = dt.date.fromisoformat
    offers = spark.createDataFrame([
        (day("1970-01-01"), day("9999-12-31"), "PCT_OFF", Decimal("10"), None, None, 1), (day("2020-01-01"), day("2020-12-31"), "AMT_OFF", Decimal("3"), "W", None, None),
        (day("2010-06-01"), day("2010-06-01"), "NEW_PRICE", Decimal("1"), None, 5, 2), (day("2020-01-01"), day("2019-01-01"), "NEW_PRICE", Decimal("0"), None, None, None),
    ], schema)
    sales = spark.createDataFrame([
        (1, day("2005-05-05"), Decimal("10"), "E", 5, 1), (2, day("2020-02-29"), Decimal("10"), "W", 5, 1), (3, day("2010-06-01"), Decimal("10"), None, 5, 2),
        (4, day("2010-06-02"), Decimal("10"), None, None, 2), (5, None, Decimal("10"), "W", 5, 1), (6, day("2020-02-29"), Decimal("2"), "W", None, None),
    ], "id int, sale_date date, unit_price decimal(8,2), region string, category_code int, item_id int")
    got = {r.id: r.best_price for r in best_prices(sales, offers).collect()}
    assert got == {1: Decimal("9.00"), 2: Decimal("7.00"), 3: Decimal("1.00"), 4: Decimal("10.00"), 5: Decimal("10.00"), 6: Decimal("0.00")}


def test_a_stretch_of_time_is_dealt_to_files_of_bounded_size(spark, folder, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 10)
    start = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    # 60 rows in the first half hour, one in the second, so that nearly all files of the second are empty.
    some = spark.range(0, 61, 1, 20).select("id", F.timestamp_add("MINUTE", F.when(F.col("id") < 60, F.col("id") % 29).otherwise(60).cast("int"), start).alias("ts"))
    path, files = streams._by_time(some, 2, F.lit(False), "ts")
    assert files == 6 and streams._files(spark, path) == 12
    assert max(r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()) < 30
    again, more = streams._by_time(some.where("id < 5"), 2, F.lit(False), "ts", path)  # a second wave into the same folder
    assert (again, more, streams._files(spark, path)) == (path, 1, 14)
    path, files = streams._by_time(some, 2, F.lit(False), "ts")
    log = folder("log")
    write_log(sources.table_files(spark, path, some.schema, files), log, folder("checkpoint")).awaitTermination()
    assert rows(read_log(spark, log, some.schema).groupBy(BATCH).count()) == [(0, 60), (1, 1)]


def test_stored_versions_rewrite_no_partition(spark, folder):
    path = folder("silver")
    write_partitioned(detail(spark, ("a", "2024-01-31", 1, 2, "1.50"), ("b", "2024-02-01", 2, 3, None), ("b", "2024-02-01", 2, 3, None)),
                      f"{path}/sales_detail", ["scan_datestamp"])
    rollups.create_rollups(spark, path)
    files = lambda: sorted(spark.read.parquet(f"{path}/sales_detail").inputFiles())
    wave = detail(spark, ("a", "2024-01-31", 1, 0, "1.50"))
    rollups.record_changes(spark, path, wave, 0)
    rollups.fold_rollups(spark, path)
    before = files()
    rollups.record_changes(spark, path, wave, 0)  # as after a failure
    assert files() == before
    same_as_rebuilt(spark, path)
    rollups.record_changes(spark, path, detail(spark, ("b", "2024-02-01", 2, 3, None)), 1)  # stored twice: one is left
    assert files() != before and spark.read.parquet(f"{path}/sales_detail").count() == 2
    same_as_rebuilt(spark, path)


def test_sales_without_offers_are_neither_listed_nor_joined(spark, monkeypatch):
    sold = spark.createDataFrame(
        [("a", "2024-01-05", "10.00", 1), ("b", "2024-01-05", "10.00", 2), ("c", "2024-03-01", "10.00", 1), ("d", "2023-12-31", "-1.00", 1),
         ("e", None, "10.00", 1), ("f", "2024-01-20", "10.00", 1), ("g", "2024-03-01", None, 1)], "scan_id string, d string, p string, item_id int",
    ).select("scan_id", F.col("d").cast("date").alias("sale_date"), F.col("p").cast("decimal(8,2)").alias("unit_price"),
             F.lit("r").alias("region"), F.lit(1).alias("category_code"), "item_id")
    offers = spark.createDataFrame(
        [("2024-01-01", "2024-01-10", "AMT_OFF", "3.00", 1), ("2024-01-15", "2024-01-31", "PCT_OFF", "50.00", None)],
        "s string, e string, discount_type string, v string, item_id int",
    ).select(F.col("s").cast("date").alias("start_date"), F.col("e").cast("date").alias("end_date"), "discount_type",
             F.col("v").cast("decimal(10,2)").alias("discount_value"), F.lit(None).cast("string").alias("region"),
             F.lit(None).cast("int").alias("category_code"), "item_id")
    written = {}
    real = promotions.staged
    monkeypatch.setattr(promotions, "staged", lambda df, label: written.setdefault(label, real(df, label)))
    found = {r.scan_id: str(r.best_price) for r in best_prices(sold, offers).collect()}
    assert found == {"a": "7.00", "b": "10.00", "c": "10.00", "d": "0.00", "e": "10.00", "f": "5.00", "g": "0.00"}
    assert written["sold"].count() == 3


def test_sales_meet_small_dimensions_without_a_shuffle(spark, folder):
    at = folder("tables")
    for name, schema, some in (
        ("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, d string",
         [(1, 1, 1, 1, 2.0, 1.5, "N", "1997-06-01"), (1, 2, 1, 2, 1.0, 2.0, "R", "1997-06-02"), (2, 3, 9, 1, 1.0, 2.0, "N", "1997-06-02"), (3, None, 1, 1, 1.0, 2.0, "N", "1997-06-02")]),
        ("part", "p_partkey long, p_brand string, p_size int, p_retailprice double", [(1, "Brand#11", 1, 1.0), (2, "Brand#12", 2, 2.0), (3, "Brand#12", 46, 2.0)]),
        ("supplier", "s_suppkey long, s_nationkey int", [(1, 5)]), ("nation", "n_nationkey int, n_name string, n_regionkey int", [(5, "N", 0)]),
        ("region", "r_regionkey int, r_name string", [(0, "ASIA")]),
    ):
        table = spark.createDataFrame(some, schema)
        (table.withColumn("l_shipdate", F.col("d").cast("timestamp_ntz")).drop("d") if name == "lineitem" else table).write.parquet(f"{at}/{name}.parquet")
    found = sales.detail(spark, at)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    got = [(r.item_id, r.store_id, str(r.scan_datestamp), r.unit_qty, str(r.net_sale), r.city, r.category_code) for r in found.collect()]
    assert sorted(got) == [(1, 1, "1997-06-01", 2, "3.00", "N", 20110), (2, 1, "1997-06-02", 0, "0.00", "N", 20120)]
