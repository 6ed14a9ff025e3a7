"""Version logs: how streams write keyed tables.

A micro-batch is stored as one partition of a log, named by its batch number.
A repeated batch replaces its own partition, so each is stored exactly once
however often executors or the driver fail, and its cost depends on the batch,
not on the table. Readers take the latest version per key; ``compact`` folds
the log into the base table from time to time, and ``drop_batches`` removes
what is folded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillhouse.sources.paths import exists, remove
from tillhouse.sources.writers import upsert_table

BATCH = "_batch"


def write_log(
    stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
    available_now: bool = True, every: str = "1 minute",
    reduced: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start a query that stores every micro-batch, or what ``reduced`` makes of it, in the log."""

    def store(batch: DataFrame, number: int) -> None:
        store_batch(batch if reduced is None else reduced(batch), number, path)

    return start(stream, store, checkpoint, output_mode, available_now, every)


def store_batch(batch: DataFrame, number: int, path: str) -> None:
    """Replace partition ``number`` of the log, in few files."""
    numbered = batch.withColumn(BATCH, F.lit(number).cast("bigint")).hint("rebalance")
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def start(
    stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, output_mode: str = "append",
    available_now: bool = True, every: str = "1 minute",
) -> StreamingQuery:
    """Start a query that hands every micro-batch and its number to ``store``."""
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.foreachBatch(store).start()


def read_log(
    spark: SparkSession, path: str, schema: StructType, after_batch: int | None = None
) -> DataFrame:
    """All logged rows with their batch number; partitions prune on it."""
    log = spark.read.schema(StructType([*schema.fields]).add(BATCH, "long")).parquet(path)
    return log if after_batch is None else log.where(F.col(BATCH) > after_batch)


def last_batch(log: DataFrame) -> int:
    """The greatest batch number, -1 for an empty log; only partition names are read."""
    return log.select(F.coalesce(F.max(BATCH), F.lit(-1))).first()[0]


def drop_batches(spark: SparkSession, path: str, last: int) -> None:
    """Remove the batches up to ``last``, once they are folded into the base table."""
    batches = spark.read.parquet(path).select(F.col(BATCH).cast("bigint").alias("n")).where(F.col("n") <= last).distinct()
    for row in batches.collect():
        if exists(spark, folder := f"{path}/{BATCH}={row['n']}"):
            remove(spark, folder)


def compact(
    spark: SparkSession, base_path: str, log: DataFrame, keys: Sequence[str],
    order: Sequence[Column], partition_by: Sequence[str], partition_fixed_by_key: bool = True,
) -> None:
    """Fold logged versions into the base table, which keeps the batch number.

    Running it twice with the same log changes nothing.
    """
    upsert_table(
        spark, base_path, log, keys, order, partition_by, partition_fixed_by_key=partition_fixed_by_key
    )
