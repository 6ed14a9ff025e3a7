"""Money as exact decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type of a stored sale and the range of a price change.
SALE_TYPE = "decimal(10,2)"
DRIFT_BASE = Decimal("0.9")
DRIFT_SPAN = Decimal("0.2")
CENT = Decimal("0.01")


def gross(quantity: Column, price: Column) -> Column:
    """Quantity times price in the type Spark derives for it."""
    return quantity * price


def cents(amount: Column) -> Column:
    """An amount of type decimal(10,2) or narrower as whole cents."""
    return (amount * 100).cast("bigint")


def gross_cents(quantity: Column, price: Column) -> Column:
    """Quantity times price in cents, where no single sale can overflow."""
    return cents(price.try_cast(SALE_TYPE)) * quantity


def total(cent_column: Column) -> Column:
    """Exact sum of cents as decimal(20,2).

    A sum of decimals is wider than 18 digits, where every addition makes an
    object; 64-bit cents are added in place and reach 92 quadrillion in money.
    """
    return (F.sum(cent_column).cast("decimal(20,0)") * F.lit(CENT)).cast("decimal(20,2)")


def net_sale(quantity: Column, price: Column) -> Column:
    """Quantity times price as decimal(10,2); NULL when it does not fit."""
    return (quantity * price).try_cast(SALE_TYPE)


def drifted_price(price: Column, draw: Column) -> Column:
    """A price changed by -10 % to +10 % for a draw in [0, 1)."""
    return (price * (F.lit(DRIFT_BASE) + F.lit(DRIFT_SPAN) * draw)).try_cast(SALE_TYPE)
