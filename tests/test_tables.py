"""Readers, writers, upserts, silver builds and reports on small tables."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillhouse import jobs, schemas
from tillhouse.functions.temporal import scans_between
from tillhouse.operators.promotions import best_prices, draft_promotions
from tillhouse.operators.versions import publish_views, read_snapshot
from tillhouse.plans import dashboard, inventory, silver
from tillhouse.sources import readers, writers



def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCAN = "scan_id string, store_id int, scan_datetime string, item_upc string, unit_qty int, unit_price decimal(8,2)"


def scans(spark, *data):
    return spark.createDataFrame([(i, s, t, u, q, Decimal(p) if p else None) for i, s, t, u, q, p in data], SCAN)


@pytest.fixture
def bronze(spark):
    return {
        "stores": spark.createDataFrame([(1, "LA", "CA", "WEST", "PST (GMT-08)"), (2, "NY", "NY", "EAST", "EST (GMT-05)")],
                                        "store_id int, city string, state string, region string, timezone string"),
        "item_master": spark.createDataFrame(
            [(10, 1, Decimal("1"), "u1", 1, 1), (20, 2, Decimal("2"), "u2", 1, 1), (10, 50000, Decimal("3"), "u3", 1, 1)],
            schemas.ITEM_MASTER),
        "item_categories": spark.createDataFrame([(10, "Food, drink", "all’s well", None, None), (20, "Toys", "", None, None)],
                                                 schemas.ITEM_CATEGORIES),
        "scans": scans(
            spark,
            ("a", 1, "2024-01-01 09:00:00", "u1", 2, "1.50"), ("b", 2, "2024-01-01 10:00:00", "u2", 1, "9.99"),
            ("c", 1, "2024-01-02 09:00:00", "u1", 0, "1.50"), ("d", 1, "2024-01-02 10:00:00", "u3", 5, "3.00"),
            ("e", 9, "2024-01-02 10:00:00", "u1", 1, "1.50"), ("f", 1, "2024-01-02 11:00:00", "u9", 1, "1.50"),
            ("g", 1, "not a time", "u1", 1, "1.50"), ("h", 2, "2024-01-02 12:00:00", "u2", 3, "10.00"),
        ),
    }


def test_dimension_hides_made_up_items(bronze):
    dim = silver.items_categories(bronze["item_master"], bronze["item_categories"])
    assert [r["item_id"] for r in dim.orderBy("item_id").collect()] == [1, 2]


def test_detail_drops_unknown_stores_and_items(bronze):
    dim = silver.items_categories(bronze["item_master"], bronze["item_categories"])
    detail = silver.sales_detail(bronze["scans"], bronze["stores"], dim)
    assert detail.columns == silver.DETAIL_COLUMNS
    assert sorted(r["scan_id"] for r in detail.collect()) == ["a", "b", "c", "g", "h"]
    assert dict(detail.dtypes)["net_sale"] == "decimal(10,2)"
    day = silver.sales_detail(bronze["scans"], bronze["stores"], dim, dt.date(2024, 1, 2))
    assert sorted(r["scan_id"] for r in day.collect()) == ["c", "h"]


def test_daily_runs_equal_the_full_build(spark, bronze, folder):
    void = bronze["scans"].where("scan_id = 'h'").withColumn("unit_qty", F.lit(0))  # bronze stores both versions
    bronze["scans"] = bronze["scans"].where("scan_id <> 'g'").union(void)
    full, daily = folder("full"), folder("daily")
    silver.build_silver(spark, bronze, full)
    first = bronze | {"scans": bronze["scans"].where("scan_datetime < '2024-01-02'")}
    silver.build_silver(spark, first, daily)
    for _ in range(2):  # a second run of a day changes nothing
        silver.build_silver(spark, bronze, daily, dt.date(2024, 1, 2))
        for table in ("items_categories", "sales_detail", "sales_by_day", "sales_by_month"):
            a, b = (readers.read_table(spark, f"{p}/{table}") for p in (full, daily))
            assert rows(a) == rows(b.select(*a.columns)), table


def test_late_void_needs_a_run_of_its_day(spark, bronze, folder):
    path = folder("silver")
    silver.build_silver(spark, bronze, path)
    voided = bronze | {"scans": bronze["scans"].withColumn("unit_qty", F.when(F.col("scan_id") == "a", 0).otherwise(F.col("unit_qty")))}
    quantity = lambda: readers.read_table(spark, f"{path}/sales_detail").where("scan_id = 'a'").first()["unit_qty"]
    silver.build_silver(spark, voided, path, dt.date(2024, 1, 2))
    assert quantity() == 2
    silver.build_silver(spark, voided, path, dt.date(2024, 1, 1))
    assert quantity() == 0


def test_rollups_add_up(spark, bronze):
    dim = silver.items_categories(bronze["item_master"], bronze["item_categories"])
    detail = silver.sales_detail(bronze["scans"], bronze["stores"], dim)
    total = detail.agg(F.sum("net_sale")).first()[0]
    for rollup in (silver.sales_by_day(detail), silver.sales_by_month(detail)):
        assert rollup.agg(F.sum("net_sales")).first()[0] == total
    assert rows(dashboard.top_categories_from_rollup(silver.sales_by_day(detail))) == rows(
        dashboard.top_categories_from_rollup(silver.sales_by_month(detail)))


def test_bronze_and_silver_top_ten_differ_by_made_up_items(bronze):
    top = dashboard.top_categories(bronze["scans"], bronze["stores"], bronze["item_master"], bronze["item_categories"])
    assert [tuple(r) for r in top.collect()] == [
        (20, "Toys", 4, Decimal("39.99")), (10, "Food, drink", 8, Decimal("19.50"))]


def test_top_ten_without_broadcast(bronze, shuffled):
    args = [bronze[t] for t in ("scans", "stores", "item_master", "item_categories")]
    assert [tuple(r) for r in dashboard.top_categories(*args).collect()] == [
        (20, "Toys", 4, Decimal("39.99")), (10, "Food, drink", 8, Decimal("19.50"))]


def test_ties_at_the_limit(spark):
    df = spark.createDataFrame([(i, str(i), 1, 5) for i in range(20)], "category_code int, category_name string, net_units int, net_sales int")
    assert [r[0] for r in dashboard.top_categories_from_rollup(df).collect()] == list(range(10))


def test_today(spark, bronze):
    assert tuple(dashboard.sales_today(bronze["scans"], dt.date(2024, 1, 2)).first()) == (Decimal("48.00"), 4)
    assert tuple(dashboard.sales_today(bronze["scans"], dt.date(2025, 1, 1)).first()) == (None, 0)


def test_average_day_skips_today_and_empty_days(spark, bronze):
    row = dashboard.average_day(bronze["scans"], dt.date(2024, 1, 3)).first()
    assert (row["avg_net_sales"], row["avg_trx"]) == (Decimal("30.50"), 3.0)
    row = dashboard.average_day(bronze["scans"], dt.date(2024, 1, 2)).first()
    assert (row["avg_net_sales"], row["avg_trx"]) == (Decimal("12.99"), 2.0)
    assert tuple(dashboard.average_day(bronze["scans"], dt.date(2025, 1, 1)).first()) == (None, None)


def test_inventory(spark):
    data = scans(
        spark, ("a", 1, "2024-01-01 23:59:59", "u", 1, "1"), ("b", 1, "2024-01-02 00:00:00", "u", 2, "1"),
        ("c", 1, "2024-01-02 08:00:00", "u", 3, "1"), ("d", None, "2024-01-02 08:00:00", "u", 3, "1"),
        ("e", 1, "2024-01-02 08:00:00", None, 3, "1"), ("f", 1, "2024-01-02 08:00:00", "u", None, "1"),
        ("g", 1, "2024-01-03 00:00:00", "u", 9, "1"), ("h", 1, "bad", "u", 9, "1"))
    as_of = dt.datetime(2024, 1, 3)
    day = inventory.inventory_delta(data, dt.date(2024, 1, 3), as_of=as_of)
    assert rows(day) == [(dt.date(2024, 1, 2), 1, "u", 5, as_of)]
    assert inventory.inventory_delta(data, dt.date(2024, 1, 3), 2).count() == 2
    assert rows(inventory.inventory_delta(data, dt.date(2024, 1, 3), as_of=as_of, fixed_format=True)) == rows(day)
    assert inventory.inventory_delta(data, dt.date(2024, 1, 3), 0).count() == 0
    large = scans(spark, *[(str(i), 1, "2024-01-02 00:00:00", "u", 2**31 - 1, "1") for i in range(2)])
    assert inventory.inventory_delta(large, dt.date(2024, 1, 3)).first()["net_quantity_delta"] is None


def test_inventory_upsert_keeps_keys_that_disappeared(spark, folder):
    path = folder("inventory")
    day, t1, t2 = dt.date(2024, 1, 2), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4)
    schema = schemas.INVENTORY_DELTA
    inventory.write_inventory_delta(spark, spark.createDataFrame([(day, 1, "u", 1, t1), (day, 2, "u", 1, t1)], schema), path, create=True)
    inventory.write_inventory_delta(spark, spark.createDataFrame([(day, 1, "u", 7, t2)], schema), path)
    inventory.write_inventory_delta(spark, spark.createDataFrame([(day, 1, "u", 3, t1)], schema), path)  # older: loses
    table = readers.read_table(spark, path).select(*schema.names)
    assert rows(table) == [(day, 1, "u", 7, t2), (day, 2, "u", 1, t1)]


def test_upsert_rewrites_only_touched_partitions(spark, folder):
    path = folder("upsert")
    base = spark.createDataFrame([(k, 1, k % 3) for k in range(9)], "k int, v int, p int")
    writers.write_partitioned(base, path, ["p"])
    local = path.removeprefix("file:")
    before = {p: sorted(os.listdir(f"{local}/p={p}")) for p in range(3)}
    updates = spark.createDataFrame([(3, 2, 0), (99, 2, 0)], "k int, v int, p int")
    writers.upsert_table(spark, path, updates, ["k"], [F.col("v")], ["p"], partition_fixed_by_key=True)
    after = {p: sorted(os.listdir(f"{local}/p={p}")) for p in range(3)}
    assert before[0] != after[0] and before[1] == after[1] and before[2] == after[2]
    assert rows(readers.read_table(spark, path).where("v = 2").select("k", "p")) == [(3, 0), (99, 0)]
    assert readers.read_table(spark, path).count() == 10


def test_upsert_moves_keys_and_clears_emptied_partitions(spark, folder):
    path = folder("upsert")
    writers.write_partitioned(spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 1)], "k int, v int, p int"), path, ["p"])
    move = spark.createDataFrame([(3, 2, 0)], "k int, v int, p int")
    writers.upsert_table(spark, path, move, ["k"], [F.col("v")], ["p"])
    assert rows(readers.read_table(spark, path).select("k", "v", "p")) == [(1, 1, 0), (2, 1, 0), (3, 2, 0)]
    back = spark.createDataFrame([(1, 2, 5), (2, 0, 7)], "k int, v int, p int")  # key 2 is older and stays
    writers.upsert_table(spark, path, back, ["k"], [F.col("v")], ["p"])
    assert rows(readers.read_table(spark, path).select("k", "v", "p")) == [(1, 2, 5), (2, 1, 0), (3, 2, 0)]


def test_upsert_with_null_partition(spark, folder):
    path = folder("upsert")
    writers.write_partitioned(spark.createDataFrame([(1, 1, None), (2, 1, 1)], "k int, v int, p int"), path, ["p"])
    writers.upsert_table(spark, path, spark.createDataFrame([(1, 2, None)], "k int, v int, p int"), ["k"], [F.col("v")], ["p"], True)
    assert {tuple(r) for r in readers.read_table(spark, path).select("k", "v", "p").collect()} == {(1, 2, None), (2, 1, 1)}


def test_overwrite_of_its_own_input(spark, folder):
    path = folder("self")
    writers.overwrite_table(spark.range(10), path)
    writers.overwrite_table(readers.read_table(spark, path).where("id > 5"), path)
    assert readers.read_table(spark, path).count() == 4


def test_failed_overwrite_keeps_the_table(spark, folder):
    path = folder("kept")
    writers.overwrite_table(spark.range(10), path)
    with pytest.raises(Exception, match="(?i)stop here"):
        writers.overwrite_table(spark.range(10).select(F.raise_error(F.lit("stop here")).alias("id")), path)
    assert readers.read_table(spark, path).count() == 10


def test_upsert_without_partitions(spark, folder):
    path = folder("flat")
    writers.overwrite_table(spark.createDataFrame([(1, 1), (2, 5), (None, 1)], "k int, v int"), path)
    writers.upsert_table(spark, path, spark.createDataFrame([(1, 2), (2, 4), (3, 9), (None, 7)], "k int, v int"), ["k"], [F.col("v")])
    assert rows(readers.read_table(spark, path)) == rows(spark.createDataFrame([(1, 2), (2, 5), (3, 9), (None, 7)], "k int, v int"))


def test_upsert_leaves_other_partitions_alone(spark, folder):
    """A key that moves on empties its partition; files of untouched ones stay, and no staged copy is left."""
    path, schema = folder("moving"), "k int, v int, p int"
    writers.write_partitioned(spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 1, 3)], schema), path, ["p"])
    before = {f for f in readers.read_table(spark, path).inputFiles() if "/p=3/" in f}
    shared = path.rsplit("/", 1)[0].removeprefix("file:")
    staged = set(os.listdir(shared))
    writers.upsert_table(spark, path, spark.createDataFrame([(1, 2, 2)], schema), ["k"], [F.col("v")], ["p"])
    table = readers.read_table(spark, path)
    assert rows(table.select("k", "v", "p")) == [(1, 2, 2), (2, 1, 2), (3, 1, 3)]
    assert {f for f in table.inputFiles() if "/p=3/" in f} == before
    assert not [f for f in table.inputFiles() if "/p=1/" in f]
    assert set(os.listdir(shared)) == staged


def test_partition_overwrite_keeps_the_others(spark, folder):
    path = folder("parts")
    writers.write_partitioned(spark.createDataFrame([(1, 1), (2, 2)], "v int, p int"), path, ["p"])
    writers.overwrite_partitions(spark.createDataFrame([(9, 2)], "v int, p int"), path, ["p"])
    assert rows(readers.read_table(spark, path).select("v", "p")) == [(1, 1), (9, 2)]
    with pytest.raises(AnalysisException):
        writers.write_partitioned(spark.range(1).withColumn("p", F.lit(1)), path, ["p"])


def test_partition_pruning(spark, folder):
    path = folder("parts")
    writers.write_partitioned(spark.createDataFrame([(1, 1), (2, 2)], "v int, p int"), path, ["p"])
    plan = readers.read_table(spark, path, where="p = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_registered_external_table(spark, folder):
    path, name = folder("external"), "till_external"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.register_table(spark.range(3), name, path)
    assert spark.table(name).count() == 3 and spark.read.parquet(path).count() == 3
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(path).count() == 3


def test_declared_tables(spark):
    schemas.create_tables(spark, "till_retail", ["item_categories", "scans"])
    try:
        assert spark.table("till_retail.scans").columns == schemas.RETAIL_SCANS.names
        assert spark.table("till_retail.scans").count() == 0
    finally:
        spark.sql("DROP DATABASE till_retail CASCADE")


def test_csv(spark, tmp_path):
    file = tmp_path / "categories.csv"
    file.write_text(
        '"category_code","category_name","category_description","_avg_price","_frequency"\n'
        '"20100","Food, drink","cigars, & smokers’ ""stuff""","2","0.6669"\n', encoding="utf-8")
    row = readers.read_csv(spark, str(file), schemas.ITEM_CATEGORIES).first()
    assert tuple(row) == (20100, "Food, drink", 'cigars, & smokers’ "stuff"', Decimal("2"), Decimal("0.6669"))


def test_scan_pushes_projection_and_predicate(spark):
    part = readers.read_table(spark, "/root/testdata/sf0.001/part.parquet", columns=["p_name"], where="p_partkey < 50")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(p_partkey,50)" in plan and "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_snapshot_and_base(spark):
    base = spark.createDataFrame([(1, 1, "old"), (2, 1, "old")], "k int, seq int, v string")
    log = spark.createDataFrame([(1, 2, "new"), (3, 1, "new")], "k int, seq int, v string")
    assert rows(read_snapshot(base, log, ["k"], [F.col("seq")])) == [(1, 2, "new"), (2, 1, "old"), (3, 1, "new")]


def test_promotions(spark):
    day = dt.date(2024, 1, 10)
    sales = spark.createDataFrame(
        [("a", day, "W", 1, 7, Decimal("10.00")), ("b", day, "E", 2, 8, Decimal("10.00")),
         ("c", dt.date(2024, 2, 1), "W", 1, 7, Decimal("10.00")), ("d", day, "W", 3, 9, Decimal("1.00"))],
        "scan_id string, sale_date date, region string, category_code int, item_id int, unit_price decimal(8,2)")
    offers = spark.createDataFrame(
        [(1, "p", day, day, "PCT_OFF", Decimal("10"), None, None, None, 0),
         (2, "p", day, day, "AMT_OFF", Decimal("2"), "W", None, None, 0),
         (3, "p", day, day, "NEW_PRICE", Decimal("7.77"), "W", 1, 7, 0),
         (4, "p", day, day, "BOGO", Decimal("50"), None, 2, None, 0),
         (5, "p", day, dt.date(2024, 1, 9), "NEW_PRICE", Decimal("0.01"), None, None, None, 0)], schemas.PROMOTIONS)
    best = {r["scan_id"]: r["best_price"] for r in best_prices(sales, offers).collect()}
    assert best == {"a": Decimal("7.77"), "b": Decimal("9.00"), "c": Decimal("10.00"), "d": Decimal("0.00")}
    none = best_prices(sales, offers.limit(0))
    assert [r["best_price"] for r in none.orderBy("scan_id").collect()] == [Decimal("10.00")] * 3 + [Decimal("1.00")]


def test_drafted_promotions_stay_in_range(spark):
    categories = spark.range(500).select(F.col("id").cast("int").alias("category_code"), F.lit("x").alias("category_name"))
    start = dt.date(2024, 1, 1)
    drafts = draft_promotions(categories, start, F.rand(1), F.rand(2), F.rand(3))
    row = drafts.agg(
        F.collect_set("discount_type").alias("kinds"), F.min("discount_value").alias("v0"), F.max("discount_value").alias("v1"),
        F.min("end_date").alias("e0"), F.max("end_date").alias("e1")).first()
    assert set(row["kinds"]) == {"PCT_OFF", "AMT_OFF", "NEW_PRICE", "BOGO"}
    assert row["v0"] == 5 and row["v1"] == 9
    assert (row["e0"] - start).days == 5 and (row["e1"] - start).days == 24


def test_detail_without_broadcast(bronze, shuffled):
    dim = silver.items_categories(bronze["item_master"], bronze["item_categories"])
    assert sorted(r["scan_id"] for r in silver.sales_detail(bronze["scans"], bronze["stores"], dim).collect()) == ["a", "b", "c", "g", "h"]


def test_days_prune_the_folders_of_bronze(spark, bronze, folder):
    path = folder("bronze")
    writers.write_partitioned(bronze["scans"].withColumn("scan_datestamp", F.to_date(F.substring("scan_datetime", 1, 10).try_cast("date"))),
                              path, ["scan_datestamp"])
    stored = readers.read_table(spark, path)
    day = dt.date(2024, 1, 2)
    for frame in (scans_between(stored, day, day + dt.timedelta(days=1)), inventory.inventory_delta(stored, day + dt.timedelta(days=1))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(scan_datestamp" in plan and "2024-01-02" in plan


def test_first_dated_run_builds_all(spark, bronze, folder):
    first, full = folder("first"), folder("full")
    silver.build_silver(spark, bronze, first, dt.date(2024, 1, 2))
    silver.build_silver(spark, bronze, full)
    for table in ("items_categories", "sales_detail", "sales_by_day", "sales_by_month"):
        a, b = (readers.read_table(spark, f"{p}/{table}") for p in (first, full))
        assert rows(a) == rows(b), table


def test_jobs(spark, bronze, folder, capsys):
    root, table = folder("bronze"), folder("inventory")
    for name, place in jobs.BRONZE.items():
        writers.overwrite_table(bronze[name], f"{root}/{place}")
    silver_path = folder("silver")
    jobs.main(["silver", "--bronze", root, "--silver", silver_path, "--full"])
    jobs.main(["silver", "--bronze", root, "--silver", silver_path, "--run-date", "2024-01-02"])
    assert readers.read_table(spark, f"{silver_path}/sales_detail").count() == 5
    for _ in range(2):
        jobs.main(["inventory", "--scans", f"{root}/retail_scans", "--table", table, "--run-date", "2024-01-03", "--lookback-days", "2"])
        assert readers.read_table(spark, table).count() == 7
    jobs.main(["dashboard", "--bronze", root, "--run-date", "2024-01-02"])
    assert "48.00" in capsys.readouterr().out


def test_views_for_sql(spark):
    base = spark.createDataFrame([(1, 0, 5), (2, 0, 6)], "k int, seq int, v int")
    log = spark.createDataFrame([(1, 1, 0)], "k int, seq int, v int")
    for unique in (False, True):
        publish_views("till_t", base, log, ["k"], [F.col("seq")], unique)
        assert spark.sql("SELECT sum(v) FROM till_t_ro").first()[0] == 11
        assert spark.sql("SELECT sum(v) FROM till_t_rt").first()[0] == 6


def test_upsert_keeps_the_partition_type(spark, folder):
    path = folder("upsert")
    schema = "k int, v int, p string"
    writers.write_partitioned(spark.createDataFrame([(1, 1, "007"), (2, 1, "010")], schema), path, ["p"])
    writers.upsert_table(spark, path, spark.createDataFrame([(1, 2, "007"), (3, 2, "010")], schema), ["k"], [F.col("v")], ["p"], True)
    table = spark.read.schema(schema).parquet(path)
    assert rows(table) == [(1, 2, "007"), (2, 1, "010"), (3, 2, "010")]


def test_upsert_moves_a_null_key(spark, folder):
    path = folder("upsert")
    schema = "k int, v int, p int"
    writers.write_partitioned(spark.createDataFrame([(None, 1, 0), (2, 1, 0)], schema), path, ["p"])
    writers.upsert_table(spark, path, spark.createDataFrame([(None, 2, 1)], schema), ["k"], [F.col("v")], ["p"])
    assert {tuple(r) for r in spark.read.schema(schema).parquet(path).collect()} == {(None, 2, 1), (2, 1, 0)}
