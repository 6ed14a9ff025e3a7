"""What random, learned and stored results must keep, with what SQL says about the same tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.draws import key_bucket, new_scan_id
from tillhouse.functions.temporal import stamp
from tillhouse.operators import sampling
from tillhouse.plans import batches, boosting, training
from tillhouse.registry.core import query
from tillhouse.registry.learning import quality_rows
from tillhouse.session import new_folder
from tillhouse.sources import retail_views as rv
from tillhouse.sources.readers import read_csv
from tillhouse.sources.writers import register_table

PARTS = T.StructType().add("p_partkey", "long").add("p_name", "string").add("p_retailprice", "double")


@query("n bigint, distinct_items bigint, known bigint, categories bigint",
       """SELECT least(5, count(*)) AS n, least(5, count(*)) AS distinct_items, least(5, count(*)) AS known, 1 AS categories
          FROM items WHERE category_code = (SELECT category_code FROM categories ORDER BY md5('11|' || category_code) LIMIT 1)""",
       ["items", "categories"])
def random_rows_of_one_category(spark, sf):
    """Five random items of a random category exist, differ and share the category."""
    items = rv.items(spark, sf)
    category = sampling.random_row(rv.categories(spark, sf), 11, F.col("category_code")).select("category_code")
    chosen = sampling.random_rows(items.join(category, "category_code"), 5, 12, F.col("item_id")).select("item_id", "category_code")
    known = items.select("item_id", F.lit(1).alias("known"))
    return chosen.join(known, "item_id", "left").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("item_id").alias("distinct_items"),
        F.count("known").alias("known"), F.countDistinct("category_code").alias("categories"))


@query("total bigint, within boolean, all_known boolean, all_distinct boolean",
       "SELECT count(*) AS total, true AS within, true AS all_known, true AS all_distinct FROM lineitem")
def sample_within_bounds(spark, sf):
    """A Bernoulli sample has its share within five deviations, of distinct rows of the table."""
    rows = rv.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias("row_id"))
    sample = sampling.coin_sample(rows, 0.3, seed=7).withColumn("drawn", F.lit(1))
    found = rows.join(sample.groupBy("row_id").agg(F.count(F.lit(1)).alias("times")), "row_id", "left")
    total, drawn = F.count(F.lit(1)), F.count("times")
    return found.agg(
        total.alias("total"), (F.abs(drawn - 0.3 * total) <= 5 * F.sqrt(0.21 * total)).alias("within"),
        (F.count(F.when(F.col("times").isNull(), 1)) + drawn == total).alias("all_known"), (F.max("times") == 1).alias("all_distinct"))


@query("n bigint, known bigint", "SELECT least(10, count(*)) AS n, least(10, count(*)) AS known FROM part")
def first_rows(spark, sf):
    parts = rv.table(spark, sf, "part").select("p_partkey")
    return sampling.head(parts, 10).join(parts.withColumnRenamed("p_partkey", "k"), F.col("p_partkey") == F.col("k"), "left").agg(
        F.count(F.lit(1)).alias("n"), F.count("k").alias("known"))


@query("n bigint, stamped text", "SELECT count(*) AS n, '2024-01-31 12:00:00' AS stamped FROM events")
def stamped_rows(spark, sf):
    rows = stamp(rv.table(spark, sf, "events"), "seen", dt.datetime(2024, 1, 31, 12))
    return rows.groupBy(F.date_format("seen", "yyyy-MM-dd HH:mm:ss").alias("stamped")).agg(F.count(F.lit(1)).alias("n"))


@query("n bigint, ids bigint, well_formed boolean", "SELECT count(*) AS n, count(*) AS ids, true AS well_formed FROM events")
def scan_ids(spark, sf):
    """A new id for every event."""
    ids = rv.table(spark, sf, "events").select(new_scan_id(21).alias("id"))
    shape = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return ids.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.min(F.col("id").rlike(shape)).alias("well_formed"))


@query("p_partkey bigint, p_name text, p_retailprice double", "SELECT p_partkey, p_name || ', \"x\"' AS p_name, p_retailprice FROM part")
def csv_round_trip(spark, sf):
    """Parts written as CSV, with commas and quotes in their names, and loaded with a declared schema."""
    path = new_folder(spark, "csv")
    parts = rv.table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(', "x"')).alias("p_name"), "p_retailprice")
    parts.write.csv(path, header=True, quoteAll=True, escape='"')
    return read_csv(spark, path, PARTS)


@query("item_id bigint, category_code bigint, base_price double", "SELECT item_id, category_code, base_price FROM items", ["items"])
def catalog_table(spark, sf):
    """A table registered by name over its files, read by name."""
    items = rv.items(spark, sf).select("item_id", "base_price", "category_code")
    path = new_folder(spark, "catalog")
    name = "till_" + path.rsplit("-", 1)[1]
    register_table(items, name, path, ["category_code"])
    return spark.table(name)


@query("n bigint, same boolean, in_range boolean, consistent boolean",
       "SELECT count(*) AS n, true AS same, true AS in_range, true AS consistent FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)")
def model_kept_on_disk(spark, sf):
    """A saved model scores every row as the one in memory, within 0 and 1, and labels agree with the threshold."""
    rows = quality_rows(spark, sf)
    model = training.fit_model(rows.where(key_bucket(F.col("doc_id")) < 70).drop("doc_id"), scale=["n_chars", "n_words"])
    path = new_folder(spark, "model")
    training.save_model(model, path)
    kept = training.score(training.load_model(path), rows.drop("target")).select(F.col("doc_id").alias("k"), F.col("score").alias("again"))
    scored = training.score(model, rows.drop("target")).join(kept, F.col("doc_id") == F.col("k"))
    label = training.predicted_label(F.col("score"))
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("score") == F.col("again")).alias("same"),
        F.min(F.col("score").between(0, 1)).alias("in_range"), F.min((label == 1) == (F.col("score") > training.THRESHOLD)).alias("consistent"))


def _learning(spark, sf):
    """Labelled documents, and those of them to train on."""
    rows = quality_rows(spark, sf)
    return rows, rows.where(key_bucket(F.col("doc_id")) < 70).drop("doc_id")


@query("n bigint, same boolean, in_range boolean, folders bigint",
       """SELECT count(*) AS n, true AS same, true AS in_range, 1 AS folders
          FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)""")
def boosting_resumed(spark, sf):
    """A run that was stopped after its first stage and resumed scores every row as one that was not."""
    rows, train = _learning(spark, sf)
    whole, stopped = new_folder(spark, "boosting"), new_folder(spark, "boosting")
    unbroken = boosting.fit_in_stages(train, whole, scale=["n_chars"], rounds=6, every=3)
    boosting.fit_in_stages(train, stopped, scale=["n_chars"], rounds=6, every=3, stop_after=3)
    resumed = boosting.fit_in_stages(train, stopped, scale=["n_chars"], rounds=6, every=3)
    again = boosting.score(resumed, rows.drop("target")).select(F.col("doc_id").alias("k"), F.col("score").alias("again"))
    both = boosting.score(unbroken, rows.drop("target")).join(again, F.col("doc_id") == F.col("k"))
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("score") == F.col("again")).alias("same"),
        F.min(F.col("score").between(0, 1)).alias("in_range"), F.lit(len(boosting.rounds_kept(spark, stopped))).alias("folders"))


@query("n bigint, same boolean",
       "SELECT count(*) AS n, true AS same FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)")
def batch_scores(spark, sf):
    """A kept model that scores Arrow batches agrees with the one that Spark runs."""
    rows, train = _learning(spark, sf)
    path = new_folder(spark, "model")
    training.save_model(training.fit_model(train, scale=["n_chars", "n_words"]), path)
    found = batches.score_batches(spark, path, rows.drop("target")).select(F.col("doc_id").alias("k"), F.col("score").alias("again"))
    both = training.score(training.load_model(path), rows.drop("target")).join(found, F.col("doc_id") == F.col("k"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.min(F.abs(F.col("score") - F.col("again")) < 1e-12).alias("same"))
