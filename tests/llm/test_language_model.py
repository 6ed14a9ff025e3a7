"""The language model against plain loops and finite differences, at the query's own sizes."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa

from tillhouse.llm import lm
from tillhouse.llm.blocks import unsqueeze


def _plain_score(model, counts, text):
    """A document's score, one word at a time."""
    w = {name: x.astype(float) for name, x in model.weights.items()}
    gap = w["classes"].shape[1] * lm.MEMBERS

    def bucket(word):
        return zlib.crc32(word.encode()) % lm.HASHED

    words = text.lower().split()
    ids = [model.vocabulary.get(x, gap - lm.HASHED + bucket(x)) for x in words]
    total = 0.0
    for i, word in enumerate(words):
        hidden = w["shift"].copy()
        for place, k in zip(w["place"], [k for k in range(-lm.SIDE, lm.SIDE + 1) if k]):
            hidden += w["embedding"][ids[i + k] if 0 <= i + k < len(ids) else gap] * place
        hidden = np.tanh(hidden)
        c, m = divmod(ids[i], lm.MEMBERS)
        for logits, at in ((hidden @ w["classes"] + w["class_shift"], c), (hidden @ w["members"][c] + w["member_shift"][c], m)):
            total += logits[at] - math.log(np.exp(logits).sum())
        if word not in model.vocabulary:
            others = sum(n for x, n in counts.items() if x not in model.vocabulary and bucket(x) == bucket(word))
            total += math.log(counts.get(word, 1) / (others + 1))
    return total


def test_scores_are_those_of_plain_loops(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{n}" for n in rng.zipf(1.2, 300) % 5000) for _ in range(40)] + ["W1 w2\tw1", "w1", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    model = lm.train(docs)
    counts = collections.Counter(x for t in texts if t for x in t.lower().split())
    assert len(counts) > len(model.vocabulary)
    asked = spark.createDataFrame(list(enumerate([*texts, "w1 neverseen w2"])), "doc_id bigint, text string")
    found = {r.doc_id: r for r in lm.score(asked, model).collect()}
    assert len(found) == len(texts) + 1
    for i in (0, 1, 17, *range(40, 45)):
        text = ([*texts, "w1 neverseen w2"][i] or "")
        assert found[i].n_tokens == len(text.split())
        assert math.isclose(found[i].log_likelihood, _plain_score(model, counts, text), rel_tol=1e-4, abs_tol=1e-6)


def test_steps_follow_finite_differences():
    """With large sums of squares a step is the gradient times a constant."""
    rng = np.random.default_rng(6)
    w = {name: x.astype(float) for name, x in lm.new_weights().items()}
    ids = (rng.zipf(1.3, 4000) % lm.SIZE).astype(np.int32)
    around = lm._around(ids, np.array([1500, 0, 2500]), lm.SIZE)
    squares = 1e8
    after = {name: x.copy() for name, x in w.items()}
    lm._step(after, {name: np.full_like(x, squares) for name, x in w.items()}, ids, around)

    def loss(name, at, by):
        moved = {**w, name: w[name].copy()}
        moved[name][at] += by
        return -lm.log_probabilities(moved, ids, around).mean()

    for name in w:
        gradient = (w[name] - after[name]) * math.sqrt(squares) / lm.RATE
        for flat in np.argsort(-np.abs(gradient), axis=None)[[0, 3, 20]]:
            at = np.unravel_index(flat, gradient.shape)
            assert math.isclose(gradient[at], (loss(name, at, 0.01) - loss(name, at, -0.01)) / 0.02, rel_tol=0.02, abs_tol=1e-5), name


def test_rare_words_are_hashed_together(monkeypatch):
    """Hashing distinct words one at a time took most of the time of reading a text."""
    words = [f"{'long' * (n % 40)}wört{n}" if n % 100 == 0 else f"w{n}" for n in range(20000)] + ["x" * n for n in range(1, 300)]
    expected = [zlib.crc32(x.encode()) % lm.HASHED for x in words]
    calls = []
    one = zlib.crc32
    monkeypatch.setattr(lm.zlib, "crc32", lambda *args: calls.append(args) or one(*args))
    distinct, ids, coded, counts = lm._coded(pa.array([" ".join(words), None, "W5 w5"]), {"w7": 0})
    assert counts.tolist() == [len(words), 0, 2]
    found = dict(zip(distinct.to_pylist(), ids.tolist()))
    assert found.pop("w7") == 0
    assert found == {x: lm.SIZE - lm.HASHED + bucket for x, bucket in zip(words, expected) if x != "w7"}
    assert len(calls) < 1000  # those of very long words


def test_chunks_carry_the_places_of_rare_words_as_one_value(spark):
    """Arrays of a number for each place are written and read one by one by the JVM."""
    texts = [" ".join(f"w{n}" for n in range(k, k + 60)) for k in range(0, 1200, 40)] + ["w1000 w1000 w1000 w3", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    model = lm.train(docs)
    chunks = lm._scored_chunks(docs, model.vocabulary, model.weights)
    assert dict(chunks.dtypes)["words"] == "array<string>" and dict(chunks.dtypes)["occurrences"] == "binary"
    row = chunks.collect()[0]
    per_doc, word, n = unsqueeze(row.occurrences)
    at = 0
    for text, k in zip(texts, per_doc.tolist()):
        rare = collections.Counter(x for x in (text or "").split() if x not in model.vocabulary)
        assert {row.words[word[i]]: n[i] for i in range(at, at + k)} == rare
        at += k
    assert at == len(word) > 0
    for some in ([None, "", " "], ["w1", None]):  # no rare words, or no words at all
        asked = spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string").coalesce(1)
        counts = collections.Counter(x for t in texts if t for x in t.split())
        for r in lm.score(asked, model).collect():
            assert math.isclose(r.log_likelihood, _plain_score(model, counts, some[r.doc_id] or ""), rel_tol=1e-4, abs_tol=1e-6)
