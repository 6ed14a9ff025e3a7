"""Changes to the item master: price updates, new items, removals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillhouse.functions.draws import key_bucket
from tillhouse.functions.money import drifted_price
from tillhouse.schemas import SYNTHETIC_ITEM_FLOOR

# Fixed values of an item that was just made up.
NEW_ITEM_PRICE = Decimal("1.00")
NEW_ITEM_CASE = 1
NEW_ITEM_WEIGHT = 1


def update_prices(items: DataFrame, chosen: DataFrame, draw: Column) -> DataFrame:
    """Drift the price of the chosen ids; all other items keep theirs."""
    flagged = chosen.select("item_id").distinct().withColumn("_chosen", F.lit(True))
    price = F.when(F.col("_chosen"), drifted_price(F.col("base_price"), draw)).otherwise(
        F.col("base_price")
    )
    return (
        items.join(flagged, "item_id", "left")
        .withColumn("base_price", price)
        .select(*items.columns)
    )


def remove_rows(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``gone``; duplicates among the rest stay."""
    return rows.join(gone.select(key), key, "left_anti").select(*rows.columns)


def next_item_id(items: DataFrame, floor: int = SYNTHETIC_ITEM_FLOOR) -> DataFrame:
    """One row: the id after the greatest one, at least ``floor``, also on an empty table."""
    following = F.coalesce(F.max("item_id") + 1, F.lit(floor))
    return items.agg(F.greatest(following, F.lit(floor)).alias("next_item_id"))


def unseen_codes(candidates: DataFrame, items: DataFrame, code: str = "upc_code") -> DataFrame:
    """Candidate rows with a code that is new to the table and unique in the batch.

    Of several candidates with one code the first by all columns stays.
    """
    first = W.partitionBy(code).orderBy(*candidates.columns)
    return (
        candidates.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
        .join(items.select(code), code, "left_anti")
        .select(*candidates.columns)
    )


def number_from(rows: DataFrame, start: Column, order: str, name: str, width: int = 4096) -> DataFrame:
    """Consecutive numbers from ``start`` in the order of a text or number column.

    Positions inside a hash block come from a window on that block; the blocks
    are offset by a running sum of their sizes, so no task sees all rows. The
    numbering is by (block, ``order``), which is fixed for given rows.
    """
    blocked = rows.withColumn("_block", key_bucket(F.col(order), width))
    sizes = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(F.col("_block").alias("_of"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_block").orderBy(order)
    return (
        blocked.join(F.broadcast(before), F.col("_block").eqNullSafe(F.col("_of")))  # at most ``width`` + 1 rows
        .withColumn(name, start + F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_block", "_of", "_before")
    )


def insert_new_items(
    items: DataFrame, candidates: DataFrame, floor: int = SYNTHETIC_ITEM_FLOOR
) -> DataFrame:
    """Items plus one dummy item per new code.

    ``candidates`` holds ``category_code`` and ``upc_code``. New ids follow the
    greatest id in use; price, case and weight are the defaults.
    """
    fresh = unseen_codes(candidates.select("category_code", "upc_code"), items)
    numbered = number_from(fresh, next_item_id(items, floor).scalar(), "upc_code", "item_id")
    types = {f.name: f.dataType for f in items.schema.fields}
    defaults = {
        "base_price": F.lit(NEW_ITEM_PRICE),
        "case_qty": F.lit(NEW_ITEM_CASE),
        "_frequency": F.lit(NEW_ITEM_WEIGHT),
    }
    added = numbered.select(*[
        defaults.get(c, F.col(c) if c in numbered.columns else F.lit(None)).cast(types[c]).alias(c)
        for c in items.columns
    ])
    return items.unionByName(added)
