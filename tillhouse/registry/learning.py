"""Training and scoring steps on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.draws import key_bucket
from tillhouse.operators.sampling import in_training_part, split_rows
from tillhouse.plans import training
from tillhouse.registry.core import query
from tillhouse.sources import retail_views as rv

SCALED = ["l_quantity", "l_extendedprice"]


def learning_rows(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date").cast("string")
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rv.table(spark, sf, "lineitem").select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in keys], day).alias("row_id"),
        "l_quantity", "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("target"),
    )


@query(
    "p_partkey bigint, brand double, name double, target bigint",
    """SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS DOUBLE) AS brand, TRY_CAST(p_name AS DOUBLE) AS name,
              p_size AS target FROM part""",
)
def numeric_coerce(spark, sf):
    rows = rv.table(spark, sf, "part").select(
        "p_partkey", F.substring("p_brand", 7, 10).alias("brand"), F.col("p_name").alias("name"),
        F.col("p_size").cast("string").alias("target"),
    )
    return training.numeric_columns(rows, keep=["p_partkey"])


@query("row_id text, in_train boolean", "SELECT row_id, in_train FROM learning_rows", ["learning_rows"])
def split_70_30(spark, sf):
    train, valid = split_rows(learning_rows(spark, sf), F.col("row_id"))
    return train.withColumn("in_train", F.lit(True)).unionByName(valid.withColumn("in_train", F.lit(False)))


_ROUNDED = ["l_quantity_mean", "l_quantity_std", "l_extendedprice_mean", "l_extendedprice_std"]


@query(
    ", ".join(f"{c} double" for c in _ROUNDED),
    """SELECT round(avg(l_quantity), 6) AS l_quantity_mean, round(stddev_pop(l_quantity), 6) AS l_quantity_std,
              round(avg(l_extendedprice), 4) AS l_extendedprice_mean,
              round(stddev_pop(l_extendedprice), 4) AS l_extendedprice_std
       FROM learning_rows WHERE in_train""",
    ["learning_rows"],
)
def scaler_fit(spark, sf):
    train, _ = split_rows(learning_rows(spark, sf), F.col("row_id"))
    stats = training.scaler_stats(train, SCALED)
    return stats.select(*[F.round(c, 6 if c.startswith("l_q") else 4).alias(c) for c in _ROUNDED])


@query(
    "row_id text, l_quantity double, l_extendedprice double",
    """SELECT row_id, round((l_quantity - qm) / qs, 6) AS l_quantity, round((l_extendedprice - pm) / ps, 6) AS l_extendedprice
       FROM learning_rows, (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(l_extendedprice) AS pm,
                                   stddev_pop(l_extendedprice) AS ps FROM learning_rows WHERE in_train)""",
    ["learning_rows"],
)
def scaler_apply(spark, sf):
    """Fitted on the training part, applied to all rows."""
    rows = learning_rows(spark, sf)
    stats = training.scaler_stats(rows.where(in_training_part(F.col("row_id"))), SCALED)
    scaled = training.scaled(rows, stats)
    return scaled.select("row_id", *[F.round(c, 6).alias(c) for c in SCALED])


@query(
    "logloss double, error double",
    """SELECT round(avg(-(target * ln(p) + (1 - target) * ln(1 - p))), 6) AS logloss,
              round(avg(CASE WHEN CAST(p > 0.5 AS INT) <> target THEN 1 ELSE 0 END), 6) AS error
       FROM (SELECT target, (l_quantity + 5) / 60 AS p FROM learning_rows)""",
    ["learning_rows"],
)
def eval_metrics(spark, sf):
    scored = learning_rows(spark, sf).withColumn("score", (F.col("l_quantity") + 5) / 60)
    result = training.metrics(scored)
    return result.select(F.round("logloss", 6).alias("logloss"), F.round("error", 6).alias("error"))


def quality_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with figures of their size."""
    documents = rv.table(spark, sf, "documents").select(
        "doc_id", F.col("n_chars").cast("string").alias("n_chars"),
        F.size(F.split("text", r"\s+")).cast("string").alias("n_words"),
        F.size(F.array_distinct(F.split("text", r"\s+"))).cast("string").alias("n_distinct"),
    )
    labels = rv.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("target"))
    return training.numeric_columns(labels.join(documents, "doc_id"), keep=["doc_id"])


@query("doc_id bigint, score double, predicted_label bigint")
def gbt_predictions(spark, sf):
    """Quality of the labelled documents from their size: train on 70 %, score the rest."""
    rows = quality_rows(spark, sf)
    in_train = key_bucket(F.col("doc_id")) < 70
    model = training.fit_model(rows.where(in_train).drop("doc_id"), scale=["n_chars", "n_words"])
    scored = training.score(model, rows.where(~in_train).drop("target"))
    return scored.select("doc_id", "score", training.predicted_label(F.col("score")).alias("predicted_label"))
