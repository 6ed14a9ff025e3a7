"""Mixing sources to target weights: whole epochs, then a weighted sample without replacement.

Sources share ``budget`` times all words by their weights. A target stops at ``max_epochs`` times the words of its
source, and what is left over is shared again by weight among the others (water filling, solved in one pass over the
sources ordered by the level at which they fill up). A source gives its whole epochs first. The rest of its target is
filled in the order of Efraimidis and Spirakis: a document's key is an exponential variable divided by its quality
weight, and documents are taken by rising key until the prefix sum of their words reaches the rest; the document that
crosses it is taken if at least half of it fits.

No source is sorted as a whole, so a hot one is no problem: keys fall into buckets of some thousand documents, bucket
sums give the prefix up to each bucket, and only the bucket in which a source reaches its rest is sorted. Its outcome is
a cut-off for each source, which the documents are compared with where they are. Only built-in functions are used.

Defined results: the draw depends on seed, doc_id and the number of equal rows alone, so reruns agree; a NULL text has size 0; a NULL source is a
source of its own, last in order; rows that repeat a doc_id in a source with equal weights are drawn one by one, each
with a number of its own in the draw; an empty table gives an empty result; other columns are ignored by ``mix`` and kept by
``mixed_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillhouse.llm.common import fresh, word_count
from tillhouse.session import staged

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
BUDGET = 1.5
MAX_EPOCHS = 2
BUCKET_DOCS = 4096
BLOCK_BITS = 12  # of the places that are numbered together
SEED = "mix-1"


def letter_share(text: Column) -> Column:
    """Share of letters among the characters, 0.05 at least: the quality weight of a text."""
    t = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))
    return F.greatest(F.lit(0.05), letters / F.greatest(F.length(t), F.lit(1)))


def exponential_key(doc_id: Column, copy: Column, weight: Column, seed: str) -> Column:
    name = F.concat(F.lit(seed + "|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    name = F.when(copy > 0, F.concat(name, F.lit("|"), copy.cast("string"))).otherwise(name)
    uniform = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    return -F.log(uniform) / weight


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (source, doc_id, weight, place and more) with copy: 0, 1, ... among rows alike in the first three.

    ``rows`` must be a table, and ``place`` tell its rows apart. Only rows that have others alike are numbered: in blocks
    of neighbouring places, after the counts of the blocks before, so that no task sorts all copies of a row.
    """
    alike = ["source", "doc_id", "weight"]
    repeated = staged(rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(
        *[F.col(c).alias(f"_{c}") for c in alike]), "mix-repeated")
    if repeated.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("bigint"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in alike])
    inside = rows.select(*alike, "place").join(repeated, same, "left_semi").withColumn("block", F.shiftright("place", BLOCK_BITS))
    counts = inside.groupBy(*alike, "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(W.partitionBy(*alike).orderBy("block")) - F.col("n")
    before = counts.select(*[F.col(c).alias(f"_{c}") for c in alike], F.col("block").alias("_block"), earlier.alias("earlier"))
    own = W.partitionBy(*alike, "block").orderBy("place")
    copies = inside.withColumn("nth", F.row_number().over(own) - 1).join(before, same & (F.col("block") == F.col("_block"))).select(
        F.col("place").alias("_place"), (F.col("nth") + F.col("earlier")).cast("bigint").alias("copy")).filter("copy > 0")
    return rows.join(copies, F.col("place") == F.col("_place"), "left").drop("_place").withColumn("copy", F.coalesce("copy", F.lit(0)))


def targets(sizes: DataFrame, weights: Sequence[float], budget: float, max_epochs: int) -> DataFrame:
    """Adds rank, epochs, rest and target to ``sizes`` (source, source_size, n_docs), one row for each source."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_level = W.orderBy("full_at", "rank")
    everything = W.partitionBy()
    return (
        sizes.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1))
        .withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("left", F.lit(budget) * F.sum("source_size").over(everything)
                    - F.coalesce(F.sum("cap").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(by_level.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("water", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything))
        .withColumn("target", F.coalesce(F.least(F.col("water") * F.col("weight"), F.col("cap")), F.col("cap")))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("buckets", F.ceil(F.col("n_docs") / BUCKET_DOCS))
        .select("source", "rank", "source_size", "target", "epochs", "rest", "buckets")
    )


def _bucket(key: Column) -> Column:
    return F.floor(key / (1 + key) * F.col("buckets"))


def _cut_offs(keyed: DataFrame) -> DataFrame:
    """rank, cut_bucket and cut_key of the sources that reach their rest within a bucket."""
    sums = keyed.groupBy("rank", "bucket").agg(F.sum("size").alias("in_bucket"), F.first("rest").alias("rest"))
    before = F.sum("in_bucket").over(W.partitionBy("rank").orderBy("bucket")) - F.col("in_bucket")
    edge = (
        sums.withColumn("before", before)
        .filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("in_bucket") >= F.col("rest")))
        .select(F.col("rank").alias("r"), F.col("bucket").alias("cut_bucket"), "before")
    )
    inside = keyed.join(edge, (F.col("rank") == F.col("r")) & (F.col("bucket") == F.col("cut_bucket")))
    prefix = F.col("before") + F.sum("size").over(
        W.partitionBy("rank", "cut_bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0))
    fits = prefix - F.col("size") / 2 <= F.col("rest")
    return inside.select("rank", "cut_bucket", "key", fits.alias("fits")).groupBy(
        F.col("rank").alias("r"), "cut_bucket").agg(F.max(F.when(F.col("fits"), F.col("key"))).alias("cut_key"))


def _copies(rows: DataFrame, weights: Sequence[float], budget: float, max_epochs: int) -> DataFrame:
    """``rows`` (source, doc_id, size, key and more) with the source's target and the number of copies the mix takes.

    ``rows`` is read more than once. The plans of the sources are written first: their size is then known, so the planner
    broadcasts them where they are small, and documents stay where they are.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    plan = staged(targets(sizes, weights, budget, max_epochs).withColumnRenamed("source", "of"), "mix-targets")

    def planned(frame: DataFrame, columns: DataFrame) -> DataFrame:
        return frame.join(columns, F.col("source").eqNullSafe(F.col("of"))).withColumn("bucket", _bucket(F.col("key")))

    keyed = planned(rows.select("source", "doc_id", "size", "key"), plan)
    with_cut = staged(plan.join(_cut_offs(keyed), F.col("rank") == F.col("r"), "left"), "mix-cuts")
    chosen = (F.col("bucket") < F.col("cut_bucket")) | (
        (F.col("bucket") == F.col("cut_bucket")) & (F.col("key") <= F.col("cut_key")))
    more = F.when((F.col("size") > 0) & F.coalesce(chosen, F.lit(False)), 1).otherwise(0)
    return planned(rows, with_cut).withColumn("copies", (F.col("epochs") + more).cast("bigint"))


def _keyed(rows: DataFrame, seed: str) -> DataFrame:
    key = exponential_key(F.col("doc_id"), F.col("copy"), F.col("weight"), seed)
    return numbered(rows).withColumn("key", key).drop("weight", "copy", "place")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
    quality: Column | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    ``quality`` is a positive weight made of the columns of ``docs``, by default ``letter_share`` of the text.
    """
    weight = letter_share(F.col(text)) if quality is None else quality
    rows = staged(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
        weight.alias("weight"), F.monotonically_increasing_id().alias("place"),
    ), "mix")
    rows = _keyed(rows, seed)
    return _copies(rows, weights, budget, max_epochs).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
    quality: Column | None = None,
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    weight = letter_share(F.col(text)) if quality is None else quality
    whole = fresh(docs, "_row")
    rows = staged(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole),
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
        weight.alias("weight"), F.monotonically_increasing_id().alias("place"),
    ), "mix")
    rows = _keyed(rows, seed)
    taken = _copies(rows, weights, budget, max_epochs).filter("copies > 0")
    return taken.select(whole, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(f"{whole}.*")
