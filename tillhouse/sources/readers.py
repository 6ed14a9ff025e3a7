"""Batch readers. Column lists and predicates reach the source through Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tillhouse.schemas import METADATA_COLUMNS


def read_table(
    spark: SparkSession,
    path: str,
    source: str = "parquet",
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Load a table by path. ``source`` names any installed data source."""
    reader = spark.read.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return _narrow(reader.load(path), columns, where)


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 16,
    **options: str,
) -> DataFrame:
    """Scan a table over JDBC; projection and predicate run in the database.

    With ``split_on`` and ``bounds`` the scan is read in parallel ranges. The
    bounds only place the ranges, rows outside them are read too.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_on is not None and bounds is not None:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=splits
        )
    return _narrow(reader.load(), columns, where)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line, quoted commas and doubled quotes, UTF-8."""
    return spark.read.schema(schema).csv(
        path, header=True, quote='"', escape='"', encoding="UTF-8", enforceSchema=False
    )


def read_base(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """Read-optimised view: base files only, without later changes."""
    return read_table(spark, path, source)


def drop_metadata(df: DataFrame, columns: Sequence[str] = METADATA_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def _narrow(df: DataFrame, columns: Sequence[str] | None, where: Column | str | None) -> DataFrame:
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df
