"""Versions, change feeds, checks, samples and running totals on small tables."""

from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillhouse.operators import activity, items, quality, sampling, totals, versions

CHECK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def brute_latest(data):
    best = {}
    for key, seq, value in data:
        best[key] = max(best.get(key, (seq, value)), (seq, value))
    return sorted((k, *v) for k, v in best.items())


VERSIONS = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 5), st.integers(0, 3)), max_size=30)
def order():
    return [F.col("seq"), F.col("v")]

SCHEMA = "k int, seq int, v int"


@CHECK
@given(VERSIONS)
def test_latest_ignores_row_order(spark, data):
    forward = versions.latest_per_key(spark.createDataFrame(data, SCHEMA), ["k"], order())
    backward = versions.latest_per_key(spark.createDataFrame(data[::-1], SCHEMA), ["k"], order())
    assert rows(forward) == rows(backward) == brute_latest(data)


@CHECK
@given(VERSIONS, VERSIONS)
def test_merge_is_the_latest_of_both_and_idempotent(spark, old, new):
    table = spark.createDataFrame(brute_latest(old), SCHEMA)
    newest = spark.createDataFrame(brute_latest(new), SCHEMA)
    once = versions.merge_latest(table, newest, ["k"], order())
    assert rows(once) == brute_latest(old + new)
    assert rows(versions.merge_latest(once, newest, ["k"], order())) == rows(once)


def test_latest_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 1)], SCHEMA)
    plan = versions.latest_per_key(df, ["k"], order())._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_changes(spark):
    table = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30), (4, "d", 40)], "id int, name string, price int")
    feed = spark.createDataFrame(
        [(1, "U", 11, 1), (1, "U", 12, 2), (2, "D", None, 1), (3, "D", None, 1), (3, "I", 33, 2), (5, "I", 50, 1),
         (6, "I", 60, 1), (6, "D", None, 2), (7, "D", None, 1)], "id int, op string, price int, seq int")
    changed = versions.apply_changes(table, feed, ["id"], [F.col("seq")])
    assert rows(changed.orderBy("id").fillna({"name": "-"})) == [
        (1, "a", 12), (3, "-", 33), (4, "d", 40), (5, "-", 50)]


def test_null_groups_and_codes_stay(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), (None, 1, 5), (None, 2, 7)], "z string, i int, v int")
    total = totals.running_total(df, "v", ["i"], F.col("i"), within=["z"])
    assert sorted((r["z"] or "", r["i"], r["running_total"]) for r in total.collect()) == [("", 1, 5), ("", 2, 12), ("a", 1, 2), ("a", 2, 5)]
    coded = spark.createDataFrame([("x",), (None,), ("y",)], "code string")
    assert sorted(r["n"] for r in items.number_from(coded, F.lit(10), "code", "n").collect()) == [10, 11, 12]


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2), (None, 1)], "k string, day int")
    parent = spark.createDataFrame([("b",), ("b",)], "pk string")
    assert rows(quality.orphan_keys(child, parent, "k", "pk")) == [("a", 2)]
    assert rows(quality.orphan_keys(child, parent, "k", "pk", F.col("day") > 1)) == [("a", 1)]
    assert rows(quality.duplicate_keys(child, ["k"])) == [("a", 2), ("b", 2)]
    assert {tuple(r) for r in quality.duplicate_keys(child, ["k"], primary=True).collect()} == {("a", 2), ("b", 2), (None, 1)}


ITEM = "category_code int, item_id int, base_price decimal(10,2), upc_code string, case_qty int, _frequency int"


def test_next_id(spark):
    def following(*ids):
        return items.next_item_id(spark.createDataFrame([(i,) for i in ids], "item_id int")).first()[0]

    assert following() == 50000
    assert following(7) == 50000
    assert following(49999) == 50000
    assert following(50000) == 50001
    assert following(61234) == 61235


def test_new_items(spark):
    master = spark.createDataFrame([(1, 60000, Decimal("5"), "20000000001", 3, 9)], ITEM)
    wanted = spark.createDataFrame(
        [(1, "20000000001"), (1, "20000000002"), (2, "20000000002"), (1, "20000000003")], "category_code int, upc_code string")
    result = items.insert_new_items(master, wanted)
    assert result.schema == master.schema or [f.dataType for f in result.schema] == [f.dataType for f in master.schema]
    added = result.where("item_id > 60000").orderBy("item_id").collect()
    assert [r.item_id for r in added] == [60001, 60002]
    assert {r.upc_code for r in added} == {"20000000002", "20000000003"}
    assert {(r.base_price, r.case_qty, r._frequency) for r in added} == {(Decimal("1.00"), 1, 1)}


def test_price_update_touches_only_the_chosen(spark):
    master = spark.createDataFrame([(1, i, Decimal("100"), str(i), 1, 1) for i in range(10)], ITEM)
    chosen = sampling.random_rows(master, 4, seed=3)
    result = items.update_prices(master, chosen, F.rand(1))
    changed = result.where("base_price <> 100")
    assert result.count() == 10 and changed.count() == 4
    assert changed.where("base_price < 90 OR base_price > 110").count() == 0


def test_removal_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    assert rows(items.remove_rows(df, spark.createDataFrame([(2,), (2,)], "k int"), "k")) == [(1, "x"), (1, "x")]


WEIGHTS = st.lists(st.integers(0, 40), min_size=1, max_size=25).filter(lambda w: sum(w) > 0)


@CHECK
@given(WEIGHTS)
def test_every_draw_finds_its_item(spark, weights):
    """All draws 1 .. total against counting through the list."""
    master = spark.createDataFrame(list(enumerate(weights)), "item_id int, _frequency int")
    weighted = totals.cumulative_weights(master, width=4)
    draws = spark.range(1, sum(weights) + 1).toDF("draw")
    picked = sampling.pick_by_weight(draws, weighted).orderBy("draw").select("item_id").collect()
    assert [r[0] for r in picked] == [i for i, w in enumerate(weights) for _ in range(w)]


def test_shares_of_weighted_draws(spark):
    """Weights 60, 30 and 10: shares within 0.05 and in the order of the weights."""
    master = spark.createDataFrame([(1, "High", 60), (2, "Medium", 30), (3, "Low", 10)], "item_id int, name string, _frequency int")
    drawn = sampling.weighted_sample(spark.range(1000), totals.cumulative_weights(master), seed=42)
    share = {r["name"]: r["share"] for r in sampling.value_shares(drawn, "name").collect()}
    assert share["High"] > share["Medium"] > share["Low"]
    for name, expected in (("High", 0.6), ("Medium", 0.3), ("Low", 0.1)):
        assert abs(share[name] - expected) < 0.05


@CHECK
@given(st.lists(st.integers(-5, 5), max_size=30))
def test_running_total(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int")
    total = totals.running_total(df, "v", ["i"], F.floor(F.col("i") / 4)).orderBy("i")
    expected, so_far = [], 0
    for v in values:
        so_far += v
        expected.append(so_far)
    assert [r["running_total"] for r in total.collect()] == expected


def test_samples(spark):
    df = spark.range(10_000)
    assert sampling.random_rows(df, 25, 1).distinct().count() == 25
    assert sampling.random_row(df, 1).count() == 1
    assert sampling.head(df, 2).count() == 2
    kept = sampling.coin_sample(df, 0.3, 1)
    assert abs(kept.count() - 3000) < 300 and kept.count() == kept.distinct().count()
    assert "TakeOrderedAndProject" in sampling.random_rows(df, 25, 1)._jdf.queryExecution().executedPlan().toString()


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000)
    train, valid = sampling.split_rows(df, F.col("id"))
    again, _ = sampling.split_rows(df.repartition(13), F.col("id"))
    assert rows(train) == rows(again)
    assert train.count() + valid.count() == 5000 and abs(train.count() - 3500) < 150


def test_zone_state_rules(spark):
    """stop before the zone is known is ignored; start does not reset the count."""
    data = [
        (1, "A", "stop", "t1", None), (2, "A", "scans", "t2", 5), (3, "B", "start", "t3", None),
        (4, "B", "scans", "t4", 7), (5, "B", "stop", "t5", None), (6, "A", "scans", "t6", 6),
        (7, "B", "start", "t7", None), (8, "C", "stop", "t8", None), (9, "D", "start", "t9", None),
        (10, "D", "stop", "ta", None), (11, "D", "scans", "tb", 2),
    ]
    messages = spark.createDataFrame(
        [(s, z, t, f"2024-{c}", c, n, n) for s, z, t, c, n in data],
        "seq long, timezone string, type string, timestamp string, localTime string, batchCount long, dataVolume long")
    state = {r["timezone"]: (r["is_running"], r["local_time"], r["last_batch_count"], r["cumulative_count"])
             for r in activity.zone_state(messages, F.col("seq")).collect()}
    assert state == {"A": (True, "t6", 6, 11), "B": (True, "t7", 7, 7), "D": (False, "tb", 2, 2)}
    assert tuple(activity.grand_totals(messages).first()) == (20, 20)


def test_messages_of_batches_can_be_read_back(spark):
    scans = spark.createDataFrame(
        [("a", 1, "2024-01-01 10:00:05", "u", 0, Decimal("1.50"), "PST (GMT-08)"),
         ("b", 1, "2024-01-01 10:00:59", "u", 2, Decimal("1.50"), "PST (GMT-08)")],
        "scan_id string, store_id int, scan_datetime string, item_upc string, unit_qty int, unit_price decimal(8,2), timezone string")
    lines = activity.scans_messages(activity.minute_batches(scans))
    message = activity.read_messages(lines).first()
    assert message["problem"] is None
    assert (message["type"], message["timestamp"], message["localTime"]) == ("scans", "2024-01-01 10:00:00", "02:00:00")
    assert (message["batchCount"], message["voidCount"]) == (2, 1)


def test_broken_messages(spark):
    lines = spark.createDataFrame([("{",), ('{"type":"other"}',), ("{}",), ('{"type":"stop","timezone":"A"}',), (None,)], "value string")
    found = Counter(r["problem"] for r in activity.read_messages(lines).collect())
    assert found == Counter({"malformed": 2, "unknown type": 2, None: 1})


def test_draw_lookup_without_broadcast(spark, shuffled):
    master = spark.createDataFrame([(1, 3), (2, 1)], "item_id int, _frequency int")
    picked = sampling.pick_by_weight(spark.range(1, 5).toDF("draw"), totals.cumulative_weights(master)).orderBy("draw")
    assert [r["item_id"] for r in picked.collect()] == [1, 1, 1, 2]


def test_merge_with_null_keys_and_ties(spark):
    schema = "a int, b int, seq int, v string"
    table = spark.createDataFrame([(1, None, 1, "old"), (1, 2, 1, "old"), (None, None, 5, "old")], schema)
    newest = spark.createDataFrame([(1, None, 1, "new"), (None, None, 4, "new"), (2, None, 1, "new")], schema)
    keys, by = ["a", "b"], [F.col("seq")]
    expected = {(1, None, 1, "new"), (1, 2, 1, "old"), (None, None, 5, "old"), (2, None, 1, "new")}
    merged = versions.merge_latest(table, newest, keys, by)
    again = versions.merge_latest(merged, newest, keys, by)
    for result in (merged, again, versions.read_snapshot(table, newest, keys, by)):
        found = [tuple(r) for r in result.collect()]
        assert set(found) == expected and len(found) == 4


def test_unknown_order_is_the_oldest(spark):
    table = spark.createDataFrame([(1, None, 10), (2, 5, 20), (3, None, 30)], SCHEMA)
    newest = spark.createDataFrame([(1, 1, 11), (2, None, 21), (3, None, 31)], SCHEMA)
    expected = [(1, 1, 11), (2, 5, 20), (3, None, 31)]
    by = [F.col("seq")]
    for result in (versions.merge_latest(table, newest, ["k"], by), versions.read_snapshot(table, newest, ["k"], by)):
        assert sorted((tuple(r) for r in result.collect()), key=lambda r: r[0]) == expected
    always = versions.merge_latest(table, newest, ["k"], by, incoming_wins=True)
    assert rows(always.select("k", "v")) == [(1, 11), (2, 21), (3, 31)]
