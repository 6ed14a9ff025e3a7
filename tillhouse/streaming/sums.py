"""Stored sums that change by signed differences.

A table of sums has key columns, sums, and in ``FOLDED`` the number of the last batch each row holds. Differences are
logged by batch (see ``logs``); readers add those that a row doesn't hold yet, and ``fold`` brings them into the table,
rewriting only the partitions they touch. The mark makes folding repeatable: a run that failed half-way, or before the
folded batches were dropped, adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators.versions import with_keys_of
from tillhouse.sources.paths import scratch, table_exists
from tillhouse.sources.writers import overwrite_partitions, overwrite_table
from tillhouse.streaming.logs import BATCH, drop_batches, read_log

FOLDED = "_folded"


def create(sums: DataFrame, path: str, partition_by: Sequence[str] = (), batch: int = -1) -> None:
    """Store sums that hold everything up to ``batch``."""
    overwrite_table(sums.withColumn(FOLDED, F.lit(batch).cast("bigint")), path, partition_by)


def read_base(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored sums; ``schema`` (of keys and sums) gives partition columns their types."""
    return spark.read.schema(T.StructType([*schema.fields]).add(FOLDED, "long")).parquet(path)


def pending(base: DataFrame, log: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Logged differences that ``base`` doesn't hold yet, one row a key, with ``_known`` where the base has the key.

    The log is summed first; while it fits in a broadcast no row of the base is shuffled.
    """
    added = [F.sum(c).alias(c) for c in sums]
    logged = log.groupBy(*keys, BATCH).agg(*added)
    marks = with_keys_of(base.select(*keys, FOLDED), logged.select(*keys).distinct(), keys, "left_semi")
    marked = with_keys_of(logged, marks, keys, "left", [FOLDED])
    late = marked.where(F.col(BATCH) > F.coalesce(FOLDED, F.lit(-1)))
    return late.groupBy(*keys).agg(*added, F.max(F.col(FOLDED).isNotNull()).alias("_known"))


def add(base: DataFrame, changes: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``base`` with ``changes`` (see ``pending``) added; ``_changed`` tells the rows they met."""
    differences = changes.select(*keys, *[F.col(c).alias(f"_d_{c}") for c in sums])
    met = with_keys_of(base, differences, keys, "left", [f"_d_{c}" for c in sums])
    changed = F.col(f"_d_{sums[0]}").isNotNull()
    updated = met.select(*keys, *[(F.col(c) + F.coalesce(f"_d_{c}", F.lit(0))).alias(c) for c in sums], FOLDED, changed.alias("_changed"))
    new = changes.where(~F.col("_known")).select(*keys, *sums, F.lit(-1).cast("bigint").alias(FOLDED), F.lit(True).alias("_changed"))
    return updated.unionByName(new)


def current(base: DataFrame, log: DataFrame | None, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Keys and sums, with all logged differences."""
    whole = base if log is None else add(base, pending(base, log, keys, sums), keys, sums)
    return whole.select(*keys, *sums)


def read(spark: SparkSession, path: str, log_path: str, schema: T.StructType, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``current`` of a stored table and its log, either of which may be absent."""
    base = read_base(spark, path, schema) if table_exists(spark, path) else spark.createDataFrame(
        [], T.StructType([*schema.fields]).add(FOLDED, "long"))
    log = read_log(spark, log_path, schema) if table_exists(spark, log_path) else None
    return current(base, log, keys, sums)


def fold(
    spark: SparkSession, path: str, log_path: str, schema: T.StructType, keys: Sequence[str], sums: Sequence[str],
    partition_by: Sequence[str] = (), rows: str | None = None,
) -> None:
    """Bring the logged batches into the stored sums, then drop them.

    ``rows`` names the sum that counts a key's rows: keys without rows leave the table in the first fold in which no
    logged batch can be older than their mark.
    """
    if not table_exists(spark, log_path):
        return
    log = read_log(spark, log_path, schema)
    first, last = log.agg(F.min(BATCH), F.max(BATCH)).first()
    if not table_exists(spark, path):
        create(spark.createDataFrame([], schema), path, partition_by)
    with scratch(spark, "fold") as folder:

        def written(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        log = log.where(F.col(BATCH) <= last)
        base = read_base(spark, path, schema)
        if partition_by:
            days = written(log.select(*partition_by).distinct(), "touched")
            base = with_keys_of(base, days, partition_by, "left_semi")
        changes = written(pending(base, log, keys, sums), "changes")
        merged = add(base, changes, keys, sums)
        if rows:
            merged = merged.where((F.col(rows) != 0) | F.col("_changed") | (F.col(FOLDED) >= first))
        held = F.greatest(FOLDED, F.lit(last)).alias(FOLDED)
        merged = written(merged.select(*keys, *sums, held), "merged")
        if partition_by:
            overwrite_partitions(merged, path, partition_by)
        else:
            overwrite_table(merged, path)
    drop_batches(spark, log_path, last)
