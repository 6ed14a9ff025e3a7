"""What several of the operators share: tables, names, words and settings."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.session import configure

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

# Bounded Arrow batches: a few very long texts must not make a batch outgrow a Python worker.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators rely on."""
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that ``frame`` does not have, in whatever case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas of ``body`` use it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, NULL text having none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which a task applies to its batches, and at its end the worker's free memory given back.

    Python workers outlive their tasks. What Arrow and the C library keep for reuse counts against the executor all the
    while, though the JVM or other workers may need it.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim:
                trim(0)

    return task


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
