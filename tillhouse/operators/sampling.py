"""Samples, weighted draws and train / validation splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillhouse.functions.draws import key_bucket


def draw_of(df: DataFrame, seed: int, key: Column | None = None) -> Column:
    """A row's draw as hexadecimal text: a hash of the seed and its key (default: all columns).

    It belongs to the row, not to its place, so a sample is the same at any partitioning and on any run, and samples of
    parts of a table can be merged.
    """
    named = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])) if key is None else key.cast("string")
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(named, F.lit(""))))


def random_rows(df: DataFrame, n: int, seed: int, key: Column | None = None) -> DataFrame:
    """The ``n`` rows with the smallest draws: each task keeps its own ``n``, and there is no full sort."""
    return df.withColumn("_draw", draw_of(df, seed, key)).orderBy("_draw").limit(n).drop("_draw")


def random_row(df: DataFrame, seed: int, key: Column | None = None) -> DataFrame:
    return random_rows(df, 1, seed, key)


def random_rows_per_group(df: DataFrame, groups: Sequence[str], n: int, seed: int, key: Column | None = None) -> DataFrame:
    """``n`` random rows of every group; a task sends ``n`` rows of a group at most, however hot it is."""
    by_draw = W.partitionBy(*groups).orderBy("_draw")
    drawn = df.withColumn("_draw", draw_of(df, seed, key))
    return drawn.withColumn("_rank", F.row_number().over(by_draw)).where(F.col("_rank") <= n).drop("_rank", "_draw")


def merge_samples(samples: Sequence[DataFrame], n: int, seed: int, key: Column | None = None) -> DataFrame:
    """The sample of the whole from the samples of its parts, made with the same ``n``, seed and key."""
    return random_rows(reduce(DataFrame.unionByName, samples), n, seed, key)


def coin_sample(df: DataFrame, share: float, seed: int, key: Column | None = None) -> DataFrame:
    """Each row is kept with the given probability; with a key, by its draw, so that a row stays in or out for good."""
    if key is None:
        return df.sample(withReplacement=False, fraction=share, seed=seed)
    draw = F.conv(F.substring(draw_of(df, seed, key), 1, 13), 16, 10).cast("bigint")
    return df.where(draw < int(share * 2**52))


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def pick_by_weight(
    draws: DataFrame, weighted: DataFrame, draw: str = "draw", weight: str = "_frequency"
) -> DataFrame:
    """The first item whose cumulative weight reaches the draw (1 .. total).

    ``weighted`` comes from ``cumulative_weights``. The weight line is cut into
    cells of the (whole) mean weight. An item is listed in every cell it
    touches, which makes fewer than three entries per item on average, and a
    draw meets only the items of its own cell through an equi-join. A heavy
    item is spread over its many cells.
    """
    items = weighted.where(F.col(weight) > 0)
    cell_width = items.agg(
        F.greatest(F.lit(1), F.floor(F.avg(weight)).cast("bigint")).alias("cell_width")
    ).scalar()
    listed = (
        items.withColumn("_width", cell_width)
        .withColumn("_cell", F.explode(F.sequence(
            F.floor(F.col("cum_before") / F.col("_width")),
            F.floor((F.col("cum_weight") - 1) / F.col("_width")),
        )))
        .drop("_width")
    )
    placed = draws.withColumn("_cell", F.floor((F.col(draw) - 1) / cell_width))
    hit = (F.col("cum_before") < F.col(draw)) & (F.col(draw) <= F.col("cum_weight"))
    return placed.join(listed, "_cell").where(hit).drop("_cell")


def weighted_sample(draw_rows: DataFrame, weighted: DataFrame, seed: int, weight: str = "_frequency") -> DataFrame:
    """One item for every row of ``draw_rows``, with replacement."""
    total = weighted.agg(F.sum(weight)).scalar()
    draws = draw_rows.withColumn("draw", (F.floor(F.rand(seed) * total) + 1).cast("bigint"))
    return pick_by_weight(draws, weighted, weight=weight)


def value_shares(df: DataFrame, value: str) -> DataFrame:
    """Share of each value among all rows."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("share", F.col("rows").cast("double") / total)


def in_training_part(key: Column, percent: int = 70) -> Column:
    return key_bucket(key, 100) < percent


def split_rows(df: DataFrame, key: Column, percent: int = 70) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows by a stable hash of the key."""
    train = in_training_part(key, percent)
    return df.where(train), df.where(~train)


def weight_shares(items: DataFrame, group: str, weight: str = "_frequency") -> DataFrame:
    """Share of each group in the total weight."""
    sums = items.groupBy(group).agg(F.sum(weight).alias("_weight"))
    total = items.agg(F.sum(weight)).scalar()
    return sums.select(group, (F.col("_weight").cast("double") / total).alias("weight_share"))
