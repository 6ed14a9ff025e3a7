"""The registered queries of the training-data operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import (
    ann, bpe, clusters, html, lines, lm, merkle, mixing, quality, simhash, sql, substrings, token_files, warc,
)
from tillhouse.llm.common import table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    vocabulary = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    return token_files.token_digest(table(spark, sf_dir, "documents"), path, vocabulary)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(encoded, ranks))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, lm.train(docs))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.METRICS, "base_failed", "words_left", "kept")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_digest(substrings.deduplicate(table(spark, sf_dir, "documents")))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.kept_digest(table(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.with_inertia(*clusters.cluster(table(spark, sf_dir, "embeddings")))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_files,
        op2_byte_bpe,
        op3_simhash,
        op4_lm_scores,
        op5_mixing,
        op6_quality_rules,
        op7_html,
        op8_substrings,
        op9_nearest,
        op10_warc,
        op11_lines,
        op12_clusters,
        op13_merkle,
    )
}

SQL: dict[str, str] = {
    "op5_mixing": sql.MIXING,
    "op6_quality_rules": sql.QUALITY_RULES,
    "op10_warc": sql.WARC,
    "op11_lines": sql.LINE_DEDUP,
    "op12_clusters": sql.CLUSTERS,
    "op13_merkle": sql.MERKLE,
}
