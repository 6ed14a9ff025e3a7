"""Table writers on plain files: append, overwrite, overwrite by partition, upsert.

Plain parquet has no MERGE, so an upsert rewrites the partitions it touches
and leaves all others alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators.versions import latest_per_key, merge_latest, with_keys_of
from tillhouse.sources.paths import remove, replace_folder, scratch


def _writer(df: DataFrame, partition_by: Sequence[str], source: str):
    if partition_by:
        # REBALANCE gathers each partition value into well-sized files and
        # splits a value that holds too many rows over several tasks.
        df = df.hint("rebalance", *partition_by)
        return df.write.format(source).partitionBy(*partition_by)
    return df.write.format(source)


def append_rows(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), source: str = "parquet"
) -> None:
    """Bulk insert: no key lookup and no sort."""
    writer = df.write.format(source).mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], source: str = "parquet"
) -> None:
    """Write a new table partitioned by the given columns."""
    _writer(df, partition_by, source).mode("errorifexists").save(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), source: str = "parquet") -> None:
    """Replace a whole table, which may be among what ``df`` reads: the new one is complete before the old one goes."""
    replace_folder(df.sparkSession, path, lambda new: _writer(df, partition_by, source).save(new))


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], source: str = "parquet"
) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    _writer(df, partition_by, source).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).save(path)


def register_table(
    df: DataFrame,
    name: str,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    source: str = "parquet",
) -> None:
    """Write to an external location and register it in the catalog."""
    _writer(df, partition_by, source).mode(mode).option("path", path).saveAsTable(name)


def _read_like(
    spark: SparkSession, path: str, source: str, like: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """Read a table with the partition types of ``like``: folder names carry no
    types, and a guess would turn the text ``007`` into a number."""
    table = spark.read.format(source).load(path)
    wanted = {name: like.schema[name].dataType for name in partition_by}
    if all(table.schema[name].dataType == kind for name, kind in wanted.items()):
        return table
    fields = [T.StructField(f.name, wanted.get(f.name, f.dataType)) for f in table.schema]
    return spark.read.format(source).schema(T.StructType(fields)).load(path)


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    partition_by: Sequence[str] = (),
    partition_fixed_by_key: bool = False,
    incoming_wins: bool = False,
    source: str = "parquet",
) -> None:
    """Insert or replace rows by key; the greatest ``order`` wins.

    With ``incoming_wins`` the order only chooses among the updates themselves.

    Only the partitions that the updates touch are read and rewritten; the join
    with them prunes the scan at run time. ``partition_fixed_by_key`` states
    that a key never changes its partition (the partition columns belong to the
    key, or later versions repeat them). Otherwise the key and partition columns
    of the whole table are scanned for older versions elsewhere, whose
    partitions are rewritten too, or removed where no row is left. A table
    without partitions is merged and replaced as a whole.
    """
    with scratch(spark, "upsert") as folder:

        def written(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        newest = written(latest_per_key(updates, keys, order), "newest")
        table = _read_like(spark, path, source, newest, partition_by)
        if not partition_by:
            overwrite_table(merge_latest(table.select(*newest.columns), newest, keys, order, incoming_wins), path, (), source)
            return
        touched = newest.select(*partition_by)
        if not partition_fixed_by_key:
            older = with_keys_of(table, newest, keys, "left_semi")
            touched = touched.unionByName(older.select(*partition_by))
        touched = written(touched.distinct(), "touched")
        current = with_keys_of(table, touched, partition_by, "left_semi")
        merged = written(merge_latest(current.select(*newest.columns), newest, keys, order, incoming_wins), "merged")
        emptied = [] if partition_fixed_by_key else _folders_without(current, merged, partition_by)
        overwrite_partitions(merged, path, partition_by, source)
        for lost in emptied:
            remove(spark, lost)


def _folders_without(current: DataFrame, merged: DataFrame, partition_by: Sequence[str]) -> list[str]:
    """The folders of the partitions of ``current`` that have no row in ``merged``."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    there = current.select(*partition_by, folder.alias("_folder")).distinct()
    return [r["_folder"] for r in with_keys_of(there, merged.select(*partition_by).distinct(), partition_by, "left_anti").collect()]
