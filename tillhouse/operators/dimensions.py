"""Joins of a large table with dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dimension: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Inner equi-join; fact rows without a dimension row vanish.

    There is no hint: the planner broadcasts a dimension whose size statistics, or measured size at run time, are below
    the session's threshold. Otherwise both sides are shuffled and adaptive execution splits hot keys.
    """
    return fact.join(dimension, [on] if isinstance(on, str) else list(on), "inner")
