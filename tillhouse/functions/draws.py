"""Random values. Every function takes a seed; equal seeds repeat a run on equal partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def new_scan_id(seed: int | None = None) -> Column:
    return F.uuid() if seed is None else F.uuid(F.lit(seed))


def pick(values: list, position: Column) -> Column:
    """The value at a 1-based position of a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


def key_bucket(key: Column, buckets: int = 100) -> Column:
    """A stable bucket of a key: the same at any partitioning and on any run."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets
