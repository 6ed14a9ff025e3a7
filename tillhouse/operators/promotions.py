"""Promotions: sample records and the best price of a sale."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.draws import pick
from tillhouse.operators.versions import with_keys_of
from tillhouse.session import staged

# Kinds of discount in the order they are drawn from, and the
# ranges of the drawn value and duration.
DISCOUNT_TYPES = ["PCT_OFF", "AMT_OFF", "NEW_PRICE", "BOGO"]
VALUE_FROM, VALUE_TO, VALUE_POWER = 5, 10, 3
DAYS_FROM, DAYS_SPAN = 5, 20

SCOPE = ("region", "category_code", "item_id")
EXACT = "decimal(18,6)"
DAY_ZERO = "0001-01-01"
TOP_LEVEL = 22  # 2^22 days reach beyond year 9999


def draft_promotions(
    categories: DataFrame, start: dt.date, type_draw: Column, value_draw: Column, days_draw: Column
) -> DataFrame:
    """One promotion per category row; draws are in [0, 1)."""
    first = F.lit(start)
    kind = pick(DISCOUNT_TYPES, (F.floor(type_draw * len(DISCOUNT_TYPES)) + 1).cast("int"))
    value = F.floor(F.pow(value_draw, F.lit(VALUE_POWER)) * (VALUE_TO - VALUE_FROM) + VALUE_FROM)
    return categories.select(
        F.concat(F.lit("Save on "), F.col("category_name")).alias("promotion_name"),
        first.alias("start_date"),
        F.date_add(first, (F.floor(days_draw * DAYS_SPAN) + DAYS_FROM).cast("int")).alias("end_date"),
        kind.alias("discount_type"),
        value.cast("decimal(10,2)").alias("discount_value"),
        F.lit(None).cast("string").alias("region"),
        F.col("category_code"),
        F.lit(None).cast(categories.schema["category_code"].dataType).alias("item_id"),
        F.lit(0).alias("conversions"),
    )


def dyadic_pieces(ranges: DataFrame, first: str, last: str) -> DataFrame:
    """``ranges`` with a row for each aligned stretch of 2^level days that their days, both ends included, are made of.

    A range has two pieces a level at most, so one that never ends has a few dozen and not a row a day. A day lies in one
    piece of every level, number ``day >> level``: that makes matching ranges an equi-join.
    """
    level = F.col("level")
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
    lo, end = day_number(F.col(first)), day_number(F.col(last)) + 1
    leveled = ranges.where(F.col(first) <= F.col(last)).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(TOP_LEVEL))))
    cut = leveled.withColumns({"_l": F.floor((lo + size - 1) / size).cast("bigint"), "_r": F.floor(end / size).cast("bigint")})
    left = F.when((F.col("_l") < F.col("_r")) & (F.col("_l") % 2 == 1), F.col("_l"))
    right = F.when((F.col("_l") + F.col("_l") % 2 < F.col("_r")) & (F.col("_r") % 2 == 1), F.col("_r") - 1)
    return cut.withColumn("piece", F.explode(F.array_compact(F.array(left, right)))).drop("_l", "_r")


def day_number(date: Column) -> Column:
    """Days since the first day of year 1."""
    return F.datediff(date, F.lit(DAY_ZERO).cast("date")).cast("bigint")


def _scope(columns: Sequence[Column]) -> Column:
    """Which scope columns are set, as the sum of 1, 2 and 4."""
    return sum((F.when(c.isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(columns)), F.lit(0))


def best_prices(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Add ``best_price``: the lowest price any matching promotion gives.

    A promotion matches on its dates and on region, category and item, where NULL stands for all. Instead of comparing
    every sale with every promotion, each distinct day and place of the sales is listed once for every set of scope
    columns in use (eight at most), with the others left out. What remains distinct, a small table for wide scopes, meets
    the pieces of the promotions (see ``dyadic_pieces``) in an equi-join, and the best offers (largest percentage, largest
    amount, lowest new price) go back the same way. The sales are joined once, with one row of offers; those of days before
    the first and after the last promotion of every set of scope columns meet none and are neither listed nor joined. A
    buy-one-get-one offer has no defined unit price and changes nothing. ``sales`` needs ``sale_date``, ``unit_price`` and
    the scope columns.
    """
    kind, value = F.col("discount_type"), F.col("discount_value")
    pieces = staged(dyadic_pieces(promotions, "start_date", "end_date").select(
        *SCOPE, "start_date", "end_date", _scope([F.col(c) for c in SCOPE]).alias("scope"), "level", "piece", F.when(kind == "PCT_OFF", value).alias("pct"),
        F.when(kind == "AMT_OFF", value).alias("amt"), F.when(kind == "NEW_PRICE", value).alias("new")), "offers")
    in_use = pieces.groupBy("scope").agg(
        F.sort_array(F.collect_set("level")).alias("levels"), F.min("start_date").alias("first"), F.max("end_date").alias("last")).collect()
    levels = {r.scope: r.levels for r in in_use}
    price = F.col("unit_price").cast(EXACT)
    if not levels:
        return sales.withColumn("best_price", F.round(price, 2).cast("decimal(10,2)"))
    best = [F.max("pct").alias("pct"), F.max("amt").alias("amt"), F.min("new").alias("new")]
    places, masked = ["sale_date", *SCOPE], ["sale_date", "scope", *(f"in_{c}" for c in SCOPE)]
    # Dealt by a fixed number, so that what is a small file still keeps all cores busy when its rows are listed.
    parts = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    days = {r.scope: F.col("sale_date").between(F.lit(r.first), F.lit(r.last)) for r in in_use}
    on_offer = F.coalesce(reduce(or_, days.values()), F.lit(False))
    sold = staged(sales.where(on_offer).select(*places).repartition(parts, *places).distinct(), "sold")
    views = [F.when(days[scope], F.struct(F.lit(scope).alias("scope"), *[
        (F.col(c) if scope >> i & 1 else F.lit(None).cast(sold.schema[c].dataType)).alias(f"in_{c}") for i, c in enumerate(SCOPE)
    ])) for scope in sorted(levels)]
    listed = sold.withColumn("_view", F.explode(F.array_compact(F.array(*views)))).select(*places, "_view.*")
    listed = listed.where(_scope([F.col(f"in_{c}") for c in SCOPE]) == F.col("scope"))  # a sale without a region is in no region
    used = F.element_at(F.create_map(*[x for k, v in levels.items() for x in (F.lit(k), F.lit(v))]), F.col("scope"))
    leveled = listed.select(*masked).distinct().withColumn("level", F.explode(used))
    placed = leveled.withColumn("piece", F.call_function("shiftright", day_number(F.col("sale_date")), F.col("level")))
    own = pieces.groupBy("scope", "level", "piece", *[F.col(c).alias(f"in_{c}") for c in SCOPE]).agg(*best)
    values = ["pct", "amt", "new"]
    # Both results are written, so that the planner knows which side is small and shuffles no sale for it.
    met = staged(with_keys_of(placed, own, ["level", "piece", *masked[1:]], "inner", values).groupBy(*masked).agg(*best), "day-offers")
    offers = staged(with_keys_of(listed, met, masked, "inner", values).groupBy(*places).agg(*best).select(
        *places, *[F.col(v).alias(f"_{v}") for v in values]), "best-offers")
    joined = with_keys_of(sales.where(on_offer), offers, places, "left", ["_pct", "_amt", "_new"])
    kept_share = (F.lit(Decimal("100.00")) - F.col("_pct")) * F.lit(Decimal("0.01"))
    lowest = F.least(
        price, (F.col("unit_price") * kept_share).cast(EXACT), (F.col("unit_price") - F.col("_amt")).cast(EXACT), F.col("_new").cast(EXACT))
    lowest = F.greatest(lowest, F.lit(0).cast(EXACT))
    cheapest = joined.select(*sales.columns, F.round(lowest, 2).cast("decimal(10,2)").alias("best_price"))
    usual = F.round(F.greatest(price, F.lit(0).cast(EXACT)), 2).cast("decimal(10,2)")
    return cheapest.unionByName(sales.where(~on_offer).withColumn("best_price", usual))
