"""Key and reference checks as report jobs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphan_keys(
    child: DataFrame, parent: DataFrame, on: str, parent_key: str | None = None,
    checked: Column | None = None,
) -> DataFrame:
    """Child keys without a parent, with their number of rows.

    Rows are counted per key before the anti-join, so a hot key is one row.
    ``checked`` limits the check to new rows, as a constraint that was added
    without validating the old ones. NULL keys refer to nothing and pass.
    """
    rows = child if checked is None else child.where(checked)
    used = rows.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("orphan_rows"))
    known = parent.select(F.col(parent_key or on).alias(on))
    return used.join(known, on, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str], primary: bool = False) -> DataFrame:
    """Keys that occur more than once.

    A unique key allows NULL any number of times; with ``primary`` every key
    with a NULL is reported, even one that occurs once.
    """
    absent = reduce(or_, [F.col(k).isNull() for k in keys])
    if primary:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")).where(absent | (F.col("key_rows") > 1))
    return (
        df.where(~absent).groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")).where(F.col("key_rows") > 1)
    )
