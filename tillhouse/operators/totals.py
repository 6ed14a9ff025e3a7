"""Running totals without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillhouse.operators.versions import with_keys_of

# Item ids per block of the cumulative weights.
ID_BLOCK = 65_536


def running_total(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    block: Column,
    within: Sequence[str] = (),
    name: str = "running_total",
) -> DataFrame:
    """Cumulative sum of ``value`` in the given order.

    ``block`` must not decrease along the order (a day for times, a range of
    ids for ids). Rows are summed per block, the few block sums get a running
    total, and each block then only adds its own rows: windows never span more
    than one block of rows. A NULL group or block is one of its own.
    """
    keys = [*within, "_block"]
    blocked = df.withColumn("_block", block)
    sums = blocked.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy(*within).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select(
        *keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        with_keys_of(blocked, before, keys, "inner", ["_before"])
        .withColumn(name, F.col("_before") + F.sum(value).over(inside))
        .drop("_block", "_before")
    )


def cumulative_weights(
    items: DataFrame, weight: str = "_frequency", key: str = "item_id", width: int = ID_BLOCK
) -> DataFrame:
    """Prefix sums of the weights in key order: ``cum_before`` and ``cum_weight``."""
    block = F.floor(F.col(key) / width)
    weighted = running_total(items, weight, [key], block, name="cum_weight")
    return weighted.withColumn("cum_before", F.col("cum_weight") - F.col(weight))


def total_weight(items: DataFrame, weight: str = "_frequency") -> DataFrame:
    return items.agg(F.sum(weight).alias("total_weight"))
