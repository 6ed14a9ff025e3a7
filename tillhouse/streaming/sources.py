"""Stream sources with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.schemas import RETAIL_SCANS


def scan_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None,
    schema: T.StructType = RETAIL_SCANS, **options: str,
) -> DataFrame:
    """Scans from JSON files that appear below ``path``."""
    return _files(spark, files_per_batch, options).schema(schema).json(path)


def line_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None, **options: str
) -> DataFrame:
    """Raw lines as ``value``, with the file they came from."""
    lines = _files(spark, files_per_batch, options).text(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("file_time"))


def table_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
    source: str = "parquet", **options: str,
) -> DataFrame:
    """Rows of any file format, such as an ``(offset, value)`` dump of a topic."""
    return _files(spark, files_per_batch, options).schema(schema).format(source).load(path)


def topic(spark: SparkSession, servers: str, name: str, **options: str) -> DataFrame:
    """Messages of a Kafka topic; needs the Kafka connector on the class path."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", name)
        .options(**options).load()
    )
    return records.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def _files(spark: SparkSession, files_per_batch: int | None, options: dict):
    reader = spark.readStream.options(**options)
    return reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)
