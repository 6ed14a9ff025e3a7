"""Change feeds folded into the tables they describe.

A folded table keeps, besides its own columns, the version of the last change of every key and whether that was a
deletion. A deleted key stays as a tombstone, so a change that arrives late, in a batch after its successor, finds that
successor and loses. Folding twice changes nothing. Tombstones go once their batch is older than the caller's horizon.

The table is partitioned by a bucket of its key; a fold reads and rewrites only the buckets that its changes touch.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators.versions import DELETE, UPDATE, with_keys_of
from tillhouse.sources.paths import remove, scratch, table_exists
from tillhouse.sources.writers import overwrite_partitions, overwrite_table
from tillhouse.streaming.logs import BATCH, drop_batches, last_batch, read_log

VERSION, DELETED, BUCKET = "_version", "_deleted", "_bucket"


class Feed(NamedTuple):
    """A table, the log of its changes, the table's key and the columns that order the changes of a key."""

    table: T.StructType
    log: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    op: str = "op"
    buckets: int = 8

    @property
    def stored(self) -> T.StructType:
        version = T.StructType([T.StructField(c, self.log[c].dataType) for c in self.order]).add(BATCH, "long")
        return T.StructType([*self.table.fields]).add(VERSION, version).add(DELETED, "boolean").add(BUCKET, "integer")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)


def create_table(rows: DataFrame, path: str, feed: Feed) -> None:
    """Store a table, as it is before any change, so that changes can be folded into it."""
    never = F.lit(None).cast(feed.stored[VERSION].dataType)
    overwrite_table(rows.select(*feed.table.names, never.alias(VERSION), F.lit(False).alias(DELETED), feed.bucket()), path, [BUCKET])


def read_stored(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    return spark.read.schema(feed.stored).parquet(path)


def read_table(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """The folded table without tombstones and marks."""
    return read_stored(spark, path, feed).where(~F.col(DELETED)).select(*feed.table.names)


def changed_rows(stored: DataFrame, log: DataFrame, feed: Feed) -> DataFrame:
    """The rows of the keys that ``log`` changes, tombstones included, as they are after it.

    The log comes down to one row for each key before it meets the table. As in ``apply_changes``, columns that the feed
    does not carry keep their value where it only updates a row, and are NULL once it deletes or inserts it.
    """
    keys, rest = feed.keys, [c for c in feed.table.names if c not in feed.keys]
    carried = [c for c in rest if c in feed.log.names]
    version = F.struct(*feed.order, F.col(BATCH).cast("long").alias(BATCH))
    last = log.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(feed.op).alias("op"), *carried), version).alias("_last"), F.max(version).alias("_new"),
        F.max(~F.col(feed.op).eqNullSafe(UPDATE)).alias("_replaced"))
    known = with_keys_of(stored, last, keys, "left_semi").withColumn("_there", F.lit(True))
    met = with_keys_of(last, known, keys, "left", [*rest, VERSION, DELETED, "_there"])
    older = F.coalesce(F.col(VERSION) > F.col("_new"), F.lit(False))
    anew = F.col("_replaced") | F.col("_there").isNull() | F.col(DELETED)

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name not in carried:
            return F.when(~anew, F.col(name)).alias(name)
        return F.when(older, F.col(name)).otherwise(F.col(f"_last.{name}")).cast(feed.table[name].dataType).alias(name)

    gone = F.when(older, F.col(DELETED)).otherwise(F.col("_last.op").eqNullSafe(DELETE))
    return met.select(
        *[value(c) for c in feed.table.names],
        F.when(older, F.col(VERSION)).otherwise(F.col("_new")).cast(feed.stored[VERSION].dataType).alias(VERSION), gone.alias(DELETED))


def read_with_log(spark: SparkSession, path: str, log_path: str, feed: Feed) -> DataFrame:
    """The table with the changes that wait in its log."""
    if not table_exists(spark, log_path):
        return read_table(spark, path, feed)
    stored, log = read_stored(spark, path, feed), read_log(spark, log_path, feed.log)
    changed = changed_rows(stored, log, feed).where(~F.col(DELETED))
    untouched = with_keys_of(stored.where(~F.col(DELETED)), log, feed.keys, "left_anti")
    return untouched.select(*feed.table.names).unionByName(changed.select(*feed.table.names))


def fold(spark: SparkSession, path: str, log_path: str, feed: Feed, keep_tombstones: int | None = None) -> None:
    """Bring the logged changes into the table, then drop their batches.

    With ``keep_tombstones`` only the tombstones of that many last batches are kept in the buckets that are rewritten; a
    change that arrives later still would bring its key back.
    """
    if not table_exists(spark, log_path):
        return
    log = read_log(spark, log_path, feed.log)
    last = last_batch(log)
    log = log.where(F.col(BATCH) <= last)
    with scratch(spark, "fold") as folder:

        def written(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        touched = {r[0] for r in log.select(feed.bucket()).distinct().collect()}  # at most the buckets
        current = read_stored(spark, path, feed).where(F.col(BUCKET).isin(*touched)).drop(BUCKET)
        changed = written(changed_rows(current, log, feed), "changed")
        merged = with_keys_of(current, changed, feed.keys, "left_anti").unionByName(changed)
        if keep_tombstones is not None:
            old = F.coalesce(F.col(f"{VERSION}.{BATCH}") <= last - keep_tombstones, F.lit(False))
            merged = merged.where(~(F.col(DELETED) & old))
        merged = written(merged.select("*", feed.bucket()), "merged")
        left = {r[0] for r in merged.select(BUCKET).distinct().collect()}
        overwrite_partitions(merged, path, [BUCKET])
        for bucket in touched - left:
            remove(spark, f"{path}/{BUCKET}={bucket}")
    drop_batches(spark, log_path, last)
