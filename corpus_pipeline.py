"""The training corpus pipeline: quality rules, near-duplicates, repeated passages, mixing, tokens.

Every stage gets all rows that its predecessor kept, as a table, and returns the columns of ``documents``; the last one
returns the tokens. NULL values, empty texts, repeated rows and empty tables are treated as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import bpe, mixing, quality, simhash, substrings
from tillhouse.llm.common import prepared, table
from tillhouse.session import staged

# SQL has neither SimHash nor byte-level BPE; the tests compare the stages with brute force.
ORACLE_SQL = None

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that fail the rules, or are little more than boilerplate of their source, go."""
    prepared(spark)
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each group of near-duplicates stays, that with the smallest id."""
    prepared(spark)
    return simhash.one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: passages that a document with a smaller id has too are removed from the texts."""
    prepared(spark)
    cut = substrings.deduplicated_rows(docs)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents as often as the mix takes them, whole epochs as repeated rows."""
    prepared(spark)
    return mixing.mixed_rows(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of every row.

    Ids are stored before they are decoded: one task would need two Python workers at a time for both.
    """
    prepared(spark)
    ranks = public_tokenizers.path(RANKS)
    encoded = staged(bpe.encode(docs, ranks, public_tokenizers.PATTERN), "ids")
    return bpe.digests(bpe.decode(encoded, ranks), "ids")


STAGES = [
    ("quality", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
