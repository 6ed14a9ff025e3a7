"""Cleaning, scaling, training, saving and scoring."""

import math

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import batches, boosting, training


def test_numbers(spark):
    df = spark.createDataFrame([("1", "x", "1"), ("1e3", None, "0"), ("", "2.5", "1.0")], "a string, b string, target string")
    result = training.numeric_columns(df)
    assert dict(result.dtypes) == {"a": "double", "b": "double", "target": "int"}
    assert [tuple(r) for r in result.collect()] == [(1.0, None, 1), (1000.0, None, 0), (None, 2.5, 1)]


def test_scaler_uses_population_deviation_and_survives_constants(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    stats = training.scaler_stats(train, ["a", "b"])
    assert [tuple(r) for r in training.scaled(train, stats).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.5), (0, 1.0)], "target int, score double")
    row = training.metrics(df).first()
    expected = -(math.log(0.9) + math.log(0.8) + math.log(0.5) + math.log(1e-16)) / 4
    assert abs(row["logloss"] - expected) < 1e-9 and row["error"] == 0.5


def test_train_save_score(spark, folder):
    data = spark.range(600).select(
        F.rand(1).alias("a"), F.when(F.col("id") % 50 != 0, F.randn(2)).alias("b"), F.lit(None).cast("double").alias("empty"),
    ).withColumn("target", (F.col("a") > 0.5).cast("int")).cache()
    model = training.fit_model(data, scale=["a"])
    path = folder("model")
    training.save_model(model, path)
    training.save_model(model, path)  # replaces the old copy
    rows = data.drop("target")
    scored = training.score(training.load_model(path), rows)
    assert scored.columns == [*rows.columns, "score"]
    assert scored.count() == 600
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    row = training.metrics(training.score(model, data)).first()
    assert row["error"] < 0.05 and row["logloss"] < 0.3
    labels = scored.select(training.predicted_label(F.col("score")).alias("label"))
    assert {r["label"] for r in labels.distinct().collect()} == {0, 1}


def _noisy(spark, n=900):
    return spark.range(n).select(
        F.rand(3).alias("a"), F.when(F.col("id") % 40 != 0, F.randn(4)).alias("b"),
    ).withColumn("target", (F.col("a") + 0.2 * F.coalesce("b", F.lit(0.0)) > 0.5).cast("int"))


def _trees(model):
    return [s.toDebugString.split("\n", 1)[1] for s in model.stages if hasattr(s, "toDebugString")]


def test_boosting_resumes_where_it_stopped(spark, folder):
    data = _noisy(spark)
    whole, stopped = folder("whole"), folder("stopped")
    unbroken = boosting.fit_in_stages(data, whole, scale=["a"], rounds=5, every=2)
    assert boosting.fit_in_stages(data, stopped, scale=["a"], rounds=5, every=2, stop_after=1) is None
    assert boosting.rounds_kept(spark, stopped) == [2]
    resumed = boosting.fit_in_stages(data.repartition(5), stopped, scale=["a"], rounds=5, every=2)
    assert len(_trees(unbroken)) == 5 and _trees(unbroken) == _trees(resumed)
    assert boosting.rounds_kept(spark, stopped) == boosting.rounds_kept(spark, whole) == [5]
    row = training.metrics(boosting.score(resumed, data)).first()
    assert row["error"] < 0.1
    before = training.metrics(training.score(training.fit_model(data, scale=["a"], rounds=5), data)).first()
    assert abs(row["logloss"] - before["logloss"]) < 0.02  # as the library's own boosting
    more = boosting.fit_in_stages(data, stopped, scale=["a"], rounds=6, every=2)  # goes on from a finished run
    assert _trees(more)[:5] == _trees(unbroken) and len(_trees(more)) == 6


def test_boosting_refuses_rounds_of_another_run(spark, folder):
    data, path = _noisy(spark, 200), folder("run")
    boosting.fit_in_stages(data, path, rounds=1)
    with pytest.raises(ValueError, match="other settings or rows"):
        boosting.fit_in_stages(data, path, rounds=2, seed=8)
    with pytest.raises(ValueError, match="other settings or rows"):
        boosting.fit_in_stages(data.where("a < 0.9"), path, rounds=2)


def test_functions_on_batches(spark):
    import pyarrow as pa

    rows, set_up = spark.range(100, numPartitions=4), spark.sparkContext.accumulator(0)

    def setup():
        set_up.add(1)
        return {"seen": 0}

    def number(batch, state):
        state["seen"] += batch.num_rows
        return pa.RecordBatch.from_pydict({"rows": pa.array([batch.num_rows]), "seen": pa.array([state["seen"]])})

    result = batches.map_batches(rows, number, "rows bigint, seen bigint", setup, batch_rows=10).collect()
    assert sorted(r.rows for r in result) == [5] * 4 + [10] * 8 and sorted(r.seen for r in result) == sorted([10, 20, 25] * 4)
    assert set_up.value == 4
    doubled = batches.map_batches(rows, lambda b: pa.RecordBatch.from_arrays([pa.compute.multiply(b.column(0), 2)], names=["id"]), "id bigint")
    assert sorted(r.id for r in doubled.collect()) == list(range(0, 200, 2))
    assert batches.map_batches(spark.range(0), number, "rows bigint, seen bigint", setup).collect() == []


def test_kept_model_scores_batches(spark, folder):
    data, path, set_up = _noisy(spark), folder("model"), spark.sparkContext.accumulator(0)
    training.save_model(training.fit_model(data, scale=["a"], rounds=4), path)
    rows = data.drop("target").withColumn("key", F.monotonically_increasing_id()).repartition(3).cache()
    mine = batches.score_batches(spark, path, rows, lambda: set_up.add(1))
    assert mine.columns == [*rows.columns, "score"]
    found = {r.key: r.score for r in mine.collect()}
    assert set_up.value == 3
    expected = {r.key: r.score for r in training.score(training.load_model(path), rows).collect()}
    assert found.keys() == expected.keys()
    assert max(abs(found[k] - expected[k]) for k in found) < 1e-12
