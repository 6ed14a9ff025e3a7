"""Uniqueness of arriving rows, asked of a small stored filter before the table.

The filter has rows of 64-bit words for each partition of the table. A key's hash names one word and ``MARKS`` bits in it;
a word holds ``KEYS_PER_WORD`` keys on average, some two bytes a key. A partition without all of a key's bits
does not have the key; a partition with them may have it, and only such partitions are read. So a batch of new keys costs a
scan of the filter and of the few partitions that hold repeated keys, or seem to (under one key in a hundred).

Marks are written before their rows. A run that fails in between leaves marks without rows, which cost a look at a
partition and change no result; the other order would let a repeated key pass. Marks only grow by appended files until
``refresh_key_filter`` makes those of a partition anew.

Keys with a NULL are equal to nothing: they have no marks and never repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators.versions import with_keys_of
from tillhouse.session import staged
from tillhouse.sources.paths import table_exists
from tillhouse.sources.writers import append_rows, overwrite_partitions

KEYS_PER_WORD = 4
MARKS = 4
# Words are numbered by this many bits. A small partition spreads its few words over many numbers, so that the join with
# new keys has no hot word; words without keys aren't stored.
SMALLEST, LARGEST = 16, 40


def _whole(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _word(hashed: Column, level: Column) -> Column:
    lowest = F.call_function("shiftleft", F.lit(1).cast("bigint"), level) - 1
    return F.shiftrightunsigned(hashed, 6 * MARKS).bitwiseAND(lowest)


def _marks(hashed: Column) -> Column:
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(63).cast("int")) for i in range(MARKS)]
    return reduce(Column.bitwiseOR, bits)


def key_filter(rows: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Partition columns, level, word and marks; the level follows from the rows of the partition."""
    hashed = rows.where(_whole(keys)).select(*partition_by, F.xxhash64(*keys).alias("_hash"))
    needed = F.ceil(F.log2(F.count(F.lit(1)) / KEYS_PER_WORD))
    sizes = hashed.groupBy(*[F.col(p).alias(f"_of_{p}") for p in partition_by]).agg(
        F.least(F.lit(LARGEST), F.greatest(F.lit(SMALLEST), needed)).cast("int").alias("level"))
    # One row per partition: adaptive execution broadcasts it once its size is known.
    same = reduce(and_, [F.col(p).eqNullSafe(F.col(f"_of_{p}")) for p in partition_by])
    return hashed.join(sizes, same).groupBy(*partition_by, "level", _word(F.col("_hash"), F.col("level")).alias("word")).agg(
        F.bit_or(_marks(F.col("_hash"))).alias("marks"))


def add_to_key_filter(rows: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Add the marks of rows that are about to be stored."""
    append_rows(key_filter(rows, keys, partition_by).hint("rebalance", *partition_by), path, partition_by)


def refresh_key_filter(table: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], touched: DataFrame | None = None) -> None:
    """Make the marks of the partitions that occur in ``touched``, or of all, anew from the table."""
    if touched is not None:
        table = with_keys_of(table, touched.select(*partition_by).distinct(), partition_by, "left_semi")
    overwrite_partitions(key_filter(table, keys, partition_by), path, partition_by)


def read_key_filter(table: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """The filter of ``table``, empty as long as nothing has been marked."""
    schema = T.StructType([table.schema[p] for p in partition_by]).add("level", "integer").add("word", "long").add("marks", "long")
    spark = table.sparkSession
    return spark.read.schema(schema).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], schema)


def maybe_stored(new: DataFrame, filters: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Distinct keys of ``new`` with each partition that may have them.

    A key is compared with the words of its number only, one per partition, and pairs without all marks end in the join.
    """
    levels = [r["level"] for r in filters.select("level").distinct().collect()]  # at most LARGEST - SMALLEST + 1 numbers
    asked = new.where(_whole(keys)).select(*keys).distinct().withColumn("_hash", F.xxhash64(*keys))
    asked = asked.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))).select(
        *keys, "_level", _word(F.col("_hash"), F.col("_level")).alias("_word"), _marks(F.col("_hash")).alias("_marks"))
    kept = filters.select(*[F.col(p).alias(f"_in_{p}") for p in partition_by], "level", "word", "marks")
    held = (F.col("_level") == F.col("level")) & (F.col("_word") == F.col("word"))
    held &= F.col("marks").bitwiseAND(F.col("_marks")) == F.col("_marks")
    return asked.join(kept, held).select(*keys, *[F.col(f"_in_{p}").alias(p) for p in partition_by]).distinct()


def _folders(candidates: DataFrame, partition_by: Sequence[str]) -> Column:
    """A predicate on the partition columns that the scan is pruned by; there are as many values as folders at most."""
    conditions = []
    for p in partition_by:
        values = [r[0] for r in candidates.select(p).distinct().collect()]
        present = F.col(p).isin([v for v in values if v is not None])
        conditions.append(present | F.col(p).isNull() if None in values else present)
    return reduce(and_, conditions)


def stored_keys(new: DataFrame, table: DataFrame, filters: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """The keys of ``new`` that the table has, with ``stored_rows``, their number there.

    Exact: what the filter lets through is looked for in the partitions it names, and in no others.
    """
    typed = new.select(*[F.col(k).cast(table.schema[k].dataType).alias(k) for k in keys])
    candidates = staged(maybe_stored(typed, filters, keys, partition_by), "candidates")
    there = table.where(_folders(candidates, partition_by)).select(*keys, *partition_by)
    found = with_keys_of(there, candidates, [*keys, *partition_by], "left_semi")
    return found.groupBy(*keys).agg(F.count(F.lit(1)).alias("stored_rows"))


def repeated_arrivals(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness: ``new_rows`` of the arriving rows and ``stored_rows`` of the table, two together at least."""
    counted = new.where(_whole(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("new_rows"))
    both = counted.join(stored, list(keys), "left").withColumn("stored_rows", F.coalesce("stored_rows", F.lit(0)))
    return both.where(F.col("new_rows") + F.col("stored_rows") > 1)


def append_unique(new: DataFrame, table: DataFrame, table_path: str, filter_path: str, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Append the rows whose keys are new and occur once, and return the keys of the others as ``repeated_arrivals`` does.

    A repeated run finds the rows of the first one stored, and adds nothing.
    """
    arrived = staged(new, "arrived")
    broken = staged(repeated_arrivals(
        arrived, stored_keys(arrived, table, read_key_filter(table, filter_path, partition_by), keys, partition_by), keys), "broken")
    fresh = staged(arrived.join(broken.select(*keys), list(keys), "left_anti"), "fresh")
    add_to_key_filter(fresh, filter_path, keys, partition_by)
    append_rows(fresh.select(*table.columns), table_path, partition_by)
    return broken
