"""The pipeline: what each stage keeps, against the operators and brute force."""

import ctypes
import hashlib
import re
import time

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tillhouse.llm import bpe, mixing, quality, simhash, substrings
from tillhouse.session import staged

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    results = []
    for name, stage in corpus_pipeline.STAGES:
        results.append(staged(stage(spark, results[-1] if results else docs, SF), name))
    good, single, cut, mixed, tokens = results
    assert all(r.columns == columns for r in results[:-1])
    verdict = {r.doc_id for r in quality.quality_rules(docs).filter("kept").collect()}
    assert {r.doc_id for r in good.collect()} == verdict and good.count() == len(verdict)
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in simhash.near_duplicates(good).collect()}
    left = {r.doc_id: (r.n_removed, r.kept_text) for r in substrings.deduplicate(single).collect()}
    before = {r.doc_id: r.text for r in single.collect()}
    for r in cut.collect():
        assert r.text == (left[r.doc_id][1] if left[r.doc_id][0] else before[r.doc_id]) and r.n_chars == len(r.text)
    assert mixed.count() == mixing.mix(cut).agg({"copies": "sum"}).first()[0]
    ranks = public_tokenizers.path(corpus_pipeline.RANKS)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(ranks), special_tokens={})
    expected = sorted((r.doc_id, coder.encode_ordinary(r.text), hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect())
    assert sorted((r.doc_id, r.ids, r.decoded_sha256) for r in tokens.collect()) == expected


def test_edge_rows(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (None, text, None, "s", 5), (2, text, "en", None, 5), (2, text, "en", None, 5)]
    path = folder()
    spark.createDataFrame(rows, docs.schema).write.parquet(path)
    for table in (spark.read.parquet(path), spark.read.parquet(path).filter("doc_id = 9")):
        found = table
        for name, stage in corpus_pipeline.STAGES:
            found = staged(stage(spark, found, SF), name)
        assert found.count() == (1 if table.count() else 0) or found.count() == 2


def held_for_nothing(batches):
    """MB that the worker can give back at once."""

    def private():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

    for _ in batches:
        pass
    time.sleep(0.5)  # so that every worker gets a task
    before = private()
    pa.default_memory_pool().release_unused()
    ctypes.CDLL(None).malloc_trim(0)
    yield pa.RecordBatch.from_pydict({"mb": [float(before - private())]})


@pytest.mark.parametrize("name", ["fingerprints", "substrings", "tokens"])
def test_workers_give_memory_back(spark, folder, name):
    path = folder()
    texts = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(400)), lambda i: F.hex(F.xxhash64("id", i))))
    spark.range(0, 8000, 1, 8).select(F.col("id").alias("doc_id"), texts.alias("text")).write.parquet(path)
    docs = spark.read.parquet(path)
    if name == "fingerprints":
        work = simhash.fingerprints(docs, "doc_id", "text", 3)
    elif name == "substrings":
        work = substrings.deduplicate(docs)
    else:
        ranks = public_tokenizers.path(corpus_pipeline.RANKS)
        work = bpe.decode(staged(bpe.encode(docs, ranks, public_tokenizers.PATTERN), "ids"), ranks)
    work.write.format("noop").mode("overwrite").save()
    assert spark.range(0, 8, 1, 8).mapInArrow(held_for_nothing, "mb double").agg(F.max("mb")).first()[0] < 16


def test_one_worker_a_task(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    plan = corpus_pipeline.token_stage(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("InArrow|InPandas", plan)) == 1
