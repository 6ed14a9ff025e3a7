"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.session import staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (a, b) with a > b; every node links its neighbours (large: the greater ones) to the least of them."""
    sides = links.union(links.select("b", "a")) if large else links
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = sides.join(least, "a")
    if large:
        out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node of its component) for every node of ``links`` (a, b) that isn't a root itself.

    Each round is written to the shared folder, so lineage stays short. The number of rounds grows with the logarithm
    of the size of a component.
    """
    now = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        now = staged(_star(_star(now, True), False), "links")
