"""SimHash components and repeated passages against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tillhouse.llm import simhash, substrings
from tillhouse.llm.components import components
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _fingerprint(text, size=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _labels(values, radius=3):
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def _near(seed, centres, each):
    draw = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = draw.getrandbits(64)
        for _ in range(each):
            out.add(c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))))
    return sorted(out)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, unique=True, max_size=60), st.integers(0, 20))
def test_forest_finds_all_within_the_radius(values, radius):
    v = np.array(values, np.uint64)
    groups = np.sort(np.arange(len(v)) % 3 % len(v))
    groups = np.unique(groups, return_inverse=True)[1]
    query, node = simhash.BKForest(groups, v).search(groups, v, radius)
    found = set(zip(query.tolist(), node.tolist()))
    assert len(found) == len(query)
    assert found == {(i, j) for i in range(len(v)) for j in range(len(v))
                     if groups[i] == groups[j] and (values[i] ^ values[j]).bit_count() <= radius}


@pytest.mark.parametrize("tree", [4096, 8])
def test_links_lose_none(spark, tree):
    values = _near(1, 12, 40)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    root = {r.node: r.root for r in components(simhash.links(fps, 3, tree)).collect()}
    label = _labels(values)
    least = {}
    for x, v in zip(label, signed):
        least[x] = min(v, least.get(x, v))
    assert {v: root.get(v, v) for v in signed} == {v: least[x] for x, v in zip(label, signed)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "a bigint, b bigint")
    root = {r.node: r.root for r in components(edges).collect()}
    assert root == {k: 0 for k in range(1, 201)} | {501: 500}


def _edge_docs():
    long = " ".join(f"word{k}" for k in range(400))
    return [(5, long), (3, long.replace("word7 ", "other ")), (9, long.upper()), (9, long), (None, long), (1, None), (2, ""), (8, " \n\t"),
            (4, "two words"), (6, "Two\nWORDS"), (7, "É à"), (10, "é à")] + [(20 + k, f"own text {k} of its {k * 7} kind and no other") for k in range(30)]


def test_near_duplicates(spark):
    docs = [(i, t, "x") for i, t in _edge_docs()]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, fp string")
    values = [_fingerprint(t) for _, t, _ in docs]
    label = _labels(values)
    got = sorted((r.doc_id or -1, r.fp, r.component_id) for r in simhash.near_duplicates(frame).collect())
    expected = []
    for (i, _, _), x, v in zip(docs, label, values):
        ids = [d[0] for d, y in zip(docs, label) if y == x and d[0] is not None]
        expected.append((i or -1, v - (1 << 64) if v >> 63 else v, min(ids)))
    assert got == sorted(expected)
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({e[2] for e in expected})


def test_ids_that_are_all_null(spark):
    frame = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x")], "doc_id bigint, text string")
    assert [r.component_id for r in simhash.near_duplicates(frame).collect()] == [None] * 3
    assert sorted(r.text for r in simhash.one_of_each(frame).collect()) == ["a b c d", "x"]


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    values = [_fingerprint(d.text) for d in docs]
    label = _labels(values)
    least = {}
    for d, x in zip(docs, label):
        least[x] = min(d.doc_id, least.get(x, d.doc_id))
    expected = sorted((d.doc_id, format(v, "016x"), least[x]) for d, v, x in zip(docs, values, label))
    assert sorted(map(tuple, QUERIES["op3_simhash"](spark, SF).collect())) == expected


def _cut(rows, window):
    first = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - window + 1):
            gram = tuple(words[k:k + window])
            if i is not None:
                first[gram] = min(i, first.get(gram, i))
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((-1 if i is None else i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _digest(frame):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.kept_digest(frame).collect())


@pytest.mark.parametrize("window", [1, 3, 6])
def test_substrings(spark, monkeypatch, window):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 2000)
    draw = random.Random(window)
    rows = [(draw.choice([None, *range(60)]), None if draw.random() < 0.1 else " ".join(
        draw.choices(["a", "b", "c", "é"], k=draw.randint(0, 30))) + draw.choice(["", " ", "\n\x0b "])) for _ in range(300)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, n_words int").repartition(5)
    assert _digest(substrings.deduplicate(docs, window=window)) == _cut(rows, window)


def test_spans_and_rows(spark):
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(1, f"one {shared}"), (2, f"a  b {shared} c {shared}"), (3, "alone  here"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in substrings.deduplicate(docs).collect()}
    assert [tuple(s) for s in got[2].spans] == [(2, 62), (63, 123)] and got[2].kept_text == "a b c"
    assert got[1].n_removed == 0 and got[1].spans == []
    kept = {r.doc_id: r.text for r in substrings.deduplicated_rows(docs).collect()}
    assert kept == {1: rows[0][1], 2: "a b c", 3: "alone  here", 4: None}


def test_substrings_query(spark):
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op8_substrings"](spark, SF).collect())) == _cut(rows, 50)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(none).count() == simhash.one_of_each(none).count() == substrings.deduplicate(none).count() == 0
