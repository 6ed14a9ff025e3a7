"""Uniqueness of arriving rows by a stored filter."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import keys
from tillhouse.sources.writers import write_partitioned

KEY, DAY = ["k"], ["day"]
FIRST = dt.date(2024, 1, 1)


@pytest.fixture
def stored(spark, folder):
    """20 days of 500 keys, one key twice, and rows without key or day."""
    rows = spark.range(10_000).select(
        F.col("id").alias("k"), F.date_add(F.lit(FIRST), F.expr("cast(id div 500 as int)")).alias("day"), F.lit("x").alias("v"))
    odd = spark.createDataFrame([(7, FIRST, "again"), (None, FIRST, "none"), (None, None, "none"), (99_999, None, "dayless")], "k bigint, day date, v string")
    path, filters = folder("table"), folder("filter")
    write_partitioned(rows.unionByName(odd), path, DAY)
    table = spark.read.schema(odd.schema).parquet(path)
    keys.refresh_key_filter(table, filters, KEY, DAY)
    return path, filters, table


def found(new, table, filters):
    rows = keys.stored_keys(new, table, filters, KEY, DAY)
    return {r.k: r.stored_rows for r in rows.collect()}


def test_stored_keys_of_any_day_are_found_and_no_others(spark, stored):
    path, filters, table = stored
    new = spark.createDataFrame([(7,), (7,), (499,), (500,), (9_999,), (10_000,), (99_999,), (-1,), (None,)], "k int")  # not the stored type
    assert found(new, table, keys.read_key_filter(table, filters, DAY)) == {7: 2, 499: 1, 500: 1, 9_999: 1, 99_999: 1}


def test_new_keys_are_rarely_let_through(spark, stored):
    path, filters, table = stored
    marks = keys.read_key_filter(table, filters, DAY)
    new = spark.range(1_000_000, 1_020_000).withColumnRenamed("id", "k")
    assert keys.maybe_stored(new, marks, KEY, DAY).count() < 200
    assert keys.maybe_stored(table.select("k"), marks, KEY, DAY).join(table.dropna(subset=["k"]), ["k"], "left_semi").select("k").distinct().count() == 10_001


def test_a_filter_that_lets_all_through_changes_no_result(spark, stored):
    _, filters, table = stored
    full = keys.read_key_filter(table, filters, DAY).withColumn("marks", F.lit(-1).cast("bigint"))
    every = spark.range(1 << 16).select(F.lit(FIRST).alias("day"), F.lit(16).alias("level"), F.col("id").alias("word"), F.lit(-1).cast("bigint").alias("marks"))
    new = spark.createDataFrame([(7,), (9_999,), (20_000,)], "k bigint")
    assert found(new, table, full.unionByName(every)) == {7: 2, 9_999: 1}


def test_only_the_folders_of_candidates_are_read(spark, stored):
    _, filters, table = stored
    new = spark.createDataFrame([(3,), (1_200,)], "k bigint")
    rows = keys.stored_keys(new, table, keys.read_key_filter(table, filters, DAY), KEY, DAY)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "table-" in line)
    pruned = scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "2024-01-01" in pruned and "2024-01-03" in pruned and "2024-01-02" not in pruned
    assert {r.k for r in rows.collect()} == {3, 1_200}


def test_append_is_repeatable_and_refresh_folds_marks(spark, stored):
    path, filters, table = stored
    new = spark.createDataFrame([
        (5, FIRST, "old"), (20_000, FIRST, "new"), (20_001, FIRST, "a"), (20_001, FIRST, "b"), (None, FIRST, "keyless"),
        (20_002, dt.date(2025, 1, 1), "new day")], "k bigint, day date, v string")
    broken = keys.append_unique(new, table, path, filters, KEY, DAY)
    assert {tuple(r) for r in broken.collect()} == {(5, 1, 1), (20_001, 2, 0)}
    table = spark.read.schema(table.schema).parquet(path)
    assert table.count() == 10_004 + 3
    again = keys.append_unique(new.dropna(subset=["k"]), table, path, filters, KEY, DAY)
    assert {r.k for r in again.collect()} == {5, 20_000, 20_001, 20_002}
    table = spark.read.schema(table.schema).parquet(path)
    assert table.count() == 10_004 + 3
    before = keys.read_key_filter(table, filters, DAY).count()
    keys.refresh_key_filter(table, filters, KEY, DAY, new.where("k = 5"))
    marks = keys.read_key_filter(table, filters, DAY)
    assert marks.count() <= before
    assert found(new, table, marks) == {5: 1, 20_000: 1, 20_002: 1}


def test_empty_tables(spark, folder):
    empty = spark.createDataFrame([], "k bigint, day date")
    path, filters = folder("table"), folder("filter")
    new = spark.createDataFrame([(1, FIRST), (1, FIRST), (2, FIRST)], "k bigint, day date")
    assert [tuple(r) for r in keys.append_unique(new, empty, path, filters, KEY, DAY).collect()] == [(1, 2, 0)]
    table = spark.read.schema(empty.schema).parquet(path)
    assert [r.k for r in table.collect()] == [2]
    assert keys.append_unique(empty, table, path, filters, KEY, DAY).count() == 0


def test_composite_keys_are_whole_or_pass(spark):
    new = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("a", None)], "x string, y int")
    stored = spark.createDataFrame([], "x string, y int, stored_rows bigint")
    assert [tuple(r) for r in keys.repeated_arrivals(new, stored, ["x", "y"]).collect()] == [("a", 1, 2, 0)]


def test_job_appends_scans_with_new_ids(spark, folder):
    from tillhouse import jobs

    rows = [("a", 1, "2024-01-01 10:00:00", "1", 1, None), ("b", 1, "2024-01-02 10:00:00", "1", 1, None)]
    more = [("a", 1, "2024-01-03 10:00:00", "1", 1, None), ("c", 1, "2024-01-03 10:00:00", "1", 1, None)]
    table, marks = folder("scans"), folder("marks")
    for batch in (rows, more, more):
        arriving = folder("arriving")
        spark.createDataFrame(batch, jobs.RETAIL_SCANS).write.parquet(arriving)
        jobs.main(["append-unique", "--arriving", arriving, "--table", table, "--filter", marks])
    assert sorted((r.scan_id, str(r.scan_datestamp)) for r in spark.read.parquet(table).collect()) == [
        ("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-03")]
