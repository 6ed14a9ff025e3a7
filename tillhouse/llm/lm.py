"""Masked pseudo-likelihood: a window network predicts every word from the words on both sides of it.

Words are those of the common separators, in lower case (ASCII). The vocabulary are the most frequent words of the whole
corpus, about the square root of its distinct words and 896 at least; other words share buckets by hash. Within its
bucket a word has its share of the bucket's occurrences in the corpus, from a table of the counts of all words, so every
word is predicted, and a rare one as rare. A word that the corpus lacks counts as one occurrence more. The network adds up the embeddings of the words
around a gap, each weighted by its place, and after a tanh predicts the class of the missing word and the word within
its class. It is trained in numpy on all documents: in each round every task runs mini-batches over its own documents
from the common model, and the models are averaged, weighted by words, in Spark. What is gathered, counts and models,
grows with the input; what reaches the driver is one vocabulary, the sums of the buckets and one model. Scoring never
holds the counts: each chunk of texts asks for its distinct rare words by a join, and waits for the answers.

A document's score is the sum of the log-probabilities of its words, each given the others around it.

Defined results: a NULL or empty text has no words and score 0; rows repeated are scored each, and count for each in
training; an empty corpus gives the untrained model, and an empty table an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.blocks import gathered, squeeze, unsqueeze
from tillhouse.session import staged

CLASSES = 32  # at least
MEMBERS = 32  # words of a class
HASHED = 128  # of the words, buckets for words that aren't frequent
SIDE = 2  # words on either side
WIDTH = 32
ROUNDS = 1
RATE = 0.1
BATCH = 8192
SEED = 11

CHUNK_BYTES = 12 << 20  # of text whose distinct words are looked up together

SIZE = CLASSES * MEMBERS  # at least; what is beyond it stands for the gap past a document's ends
CHUNK = (
    "chunk bigint, doc_id array<bigint>, n_tokens array<bigint>, log_likelihood array<double>, words array<string>, "
    "occurrences binary")
HEAD = 64  # bytes of a word that are hashed along with those of the other words
CRC = np.array([zlib.crc32(bytes([k ^ 0xFF])) ^ 0xFF000000 for k in range(256)], np.uint32)  # what a byte does to CRC-32


class Model(NamedTuple):
    vocabulary: dict[str, int]
    weights: dict[str, np.ndarray]
    counts: DataFrame  # word and n of all words
    rare: list[int]  # occurrences of the words of each bucket


def classes_of(vocabulary: dict[str, int]) -> int:
    return max(CLASSES, math.ceil((len(vocabulary) + HASHED) / MEMBERS))


def shapes(classes: int) -> dict[str, tuple[int, ...]]:
    return {
        "embedding": (classes * MEMBERS + 1, WIDTH), "place": (2 * SIDE, WIDTH), "shift": (WIDTH,), "classes": (WIDTH, classes),
        "class_shift": (classes,), "members": (classes, WIDTH, MEMBERS), "member_shift": (classes, MEMBERS),
    }


def new_weights(classes: int = CLASSES) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    out = {name: (0.1 * rng.normal(size=shape)).astype(np.float32) for name, shape in shapes(classes).items()}
    out["place"] += 1
    return out


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """word and n over all documents; tasks send each distinct word of a batch once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, CHUNK_BYTES):
            found = _words(batch.column(0))[0].value_counts()
            yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])

    return docs.select(text).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many each has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string()))
    words, offsets = lists.values, lists.offsets.to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), np.diff(before[offsets])


def _crc32(words: pa.Array) -> np.ndarray:
    """CRC-32 of each word: all words at once, byte by byte, and what is beyond ``HEAD`` bytes one by one."""
    raw = words.cast(pa.large_binary())
    _, offsets, data = raw.buffers()
    offsets, data = np.frombuffer(offsets, np.int64)[raw.offset:raw.offset + len(raw) + 1], np.frombuffer(data, np.uint8)
    lengths = np.diff(offsets)
    short = np.minimum(lengths, HEAD).astype(np.uint8)
    order = np.argsort(HEAD - short, kind="stable")
    starts, state = offsets[:-1][order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k, n in enumerate(len(order) - np.cumsum(np.bincount(short))[:-1]):
        own = state[:n]
        byte = own.astype(np.uint8) ^ data.take(starts[:n] + k)
        own >>= 8
        own ^= CRC.take(byte)
    out = np.empty(len(order), np.int64)
    out[order] = ~state
    for i in np.flatnonzero(lengths > HEAD):
        out[i] = zlib.crc32(data[offsets[i] + HEAD:offsets[i + 1]], int(out[i]))
    return out


def _coded(texts: pa.Array, vocabulary: dict[str, int]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, their ids, all words as numbers into these, and how many words each text has."""
    words, counts = _words(texts)
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    ids = pc.index_in(distinct.cast(pa.string()), pa.array(list(vocabulary), pa.string())).fill_null(-1).to_numpy().astype(np.int32)
    rare = np.flatnonzero(ids < 0)
    if len(rare):
        ids[rare] = classes_of(vocabulary) * MEMBERS - HASHED + _crc32(distinct.take(pa.array(rare))) % HASHED
    return coded.dictionary, ids, coded.indices.to_numpy(), counts


def _around(ids: np.ndarray, counts: np.ndarray, gap: int) -> np.ndarray:
    """The ids around each of ``ids``."""
    text = np.repeat(np.arange(len(counts)), counts)
    spread = np.full(len(ids) + SIDE * (len(counts) + 1), gap, ids.dtype)
    at = np.arange(len(ids)) + SIDE * (text + 1)
    spread[at] = ids
    return np.stack([spread[at + k] for k in range(-SIDE, SIDE + 1) if k])


def _contexts(texts: pa.Array, vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids, the ids around each of them, and how many words each text has."""
    _, ids, words, counts = _coded(texts, vocabulary)
    size = classes_of(vocabulary) * MEMBERS
    ids = ids.astype(np.uint16 if size < 1 << 16 else np.int32)[words]  # short ones sort faster
    return ids, _around(ids, counts, size), counts


def _capped(logits: np.ndarray) -> np.ndarray:
    return np.minimum(logits, 60, out=logits) if logits.max() > 60 else logits


def _soft(logits: np.ndarray) -> np.ndarray:
    np.exp(_capped(logits), out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _logits(w: dict[str, np.ndarray], ids: np.ndarray, around: np.ndarray):
    """Hidden values, logits of the classes, where classes start and logits of the members; words come by class."""
    hidden = np.repeat(w["shift"][None], len(ids), axis=0)
    for place, near in zip(w["place"], around):
        hidden += (w["embedding"] * place).take(near, axis=0)
    np.tanh(hidden, out=hidden)
    classes = hidden @ w["classes"]
    classes += w["class_shift"]
    stops = np.searchsorted(ids, np.arange(w["classes"].shape[1] + 1) * MEMBERS)
    members = np.empty((len(ids), MEMBERS), np.float32)
    for c in np.flatnonzero(np.diff(stops)):
        rows = slice(stops[c], stops[c + 1])
        np.matmul(hidden[rows], w["members"][c], out=members[rows])
        members[rows] += w["member_shift"][c]
    return hidden, classes, stops, members


def _log_chance(logits: np.ndarray, rows: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities of one column in each row."""
    own = _capped(logits)[rows, of].astype(np.float64)
    np.exp(logits, out=logits)
    return np.log(np.exp(own) / logits.sum(axis=1) + 1e-30)


def log_probabilities(w: dict[str, np.ndarray], ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    out = np.empty(len(ids))
    for at in range(0, len(ids), BATCH):
        own, near = ids[at:at + BATCH], around[:, at:at + BATCH]
        order = np.argsort(own, kind="stable")
        own = own[order]
        _, classes, _, members = _logits(w, own, near[:, order])
        rows = np.arange(len(own))
        out[at + order] = _log_chance(classes, rows, own // MEMBERS) + _log_chance(members, rows, own % MEMBERS)
    return out


def _step(w: dict[str, np.ndarray], state: dict[str, np.ndarray], ids: np.ndarray, around: np.ndarray) -> None:
    """A mini-batch of gradient descent, with steps scaled by the gradients so far."""
    order = np.argsort(ids, kind="stable")
    ids, around = ids[order], around[:, order]
    rows = np.arange(len(ids))
    hidden, classes, stops, members = _logits(w, ids, around)
    _soft(classes)
    _soft(members)
    classes[rows, ids // MEMBERS] -= 1
    members[rows, ids % MEMBERS] -= 1
    back = classes @ w["classes"].T
    met = np.flatnonzero(np.diff(stops))
    grad = {"classes": hidden.T @ classes, "class_shift": classes.sum(axis=0), "place": np.empty_like(w["place"])}
    in_class, shifts = np.empty((len(met), WIDTH, MEMBERS), np.float32), np.empty((len(met), MEMBERS), np.float32)
    for i, c in enumerate(met.tolist()):
        own = slice(stops[c], stops[c + 1])
        np.matmul(hidden[own].T, members[own], out=in_class[i])
        np.add.reduceat(members[own], [0], axis=0, out=shifts[i:i + 1])
        back[own] += members[own] @ w["members"][c].T
    back -= back * hidden * hidden
    grad["shift"] = back.sum(axis=0)
    embedding = np.zeros_like(w["embedding"])
    seen = np.zeros(len(embedding), bool)
    for k, words in enumerate(around):
        near = np.argsort(words, kind="stable")
        words = words[near]
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        found, sums = words[first], np.add.reduceat(back.take(near, axis=0), first, axis=0)
        embedding[found] += sums * w["place"][k]
        grad["place"][k] = (sums * w["embedding"][found]).sum(axis=0)
        seen[found] = True
    for name, g in grad.items():
        w[name] -= _scaled_step(state[name], slice(None), g, len(ids))
    # Only the classes and rows that the words met have gradients.
    near = np.flatnonzero(seen)
    w["embedding"][near] -= _scaled_step(state["embedding"], near, embedding[near], len(ids))
    w["members"][met] -= _scaled_step(state["members"], met, in_class, len(ids))
    w["member_shift"][met] -= _scaled_step(state["member_shift"], met, shifts, len(ids))


def _scaled_step(state: np.ndarray, at, g: np.ndarray, n: int) -> np.ndarray:
    g /= n
    squares = state[at] + g * g
    state[at] = squares
    np.sqrt(squares, out=squares)
    squares += 1e-6
    g *= RATE
    g /= squares
    return g


def _trained(docs: DataFrame, text: str, model: Model) -> dict[str, np.ndarray]:
    """The average of the models that the tasks reach from ``model``, weighted by words."""
    vocabulary, start = model.vocabulary, model.weights

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = {name: x.copy() for name, x in start.items()}
        state = {name: np.zeros_like(x) for name, x in w.items()}
        n = 0
        for batch in gathered(batches, CHUNK_BYTES):
            ids, around, _ = _contexts(batch.column(0), vocabulary)
            for at in range(0, len(ids), BATCH):
                _step(w, state, ids[at:at + BATCH], around[:, at:at + BATCH])
            n += len(ids)
        if n:
            yield pa.RecordBatch.from_pydict({
                "name": list(w), "n": pa.array([n] * len(w), pa.int64()), "data": [x.astype("<f4").tobytes() for x in w.values()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for batch in batches:
            for name, n, data in zip(*(batch.column(c).to_pylist() for c in ("name", "n", "data"))):
                held = sums.setdefault(name, [0, 0.0])
                held[0] += n
                held[1] = held[1] + n * np.frombuffer(data, "<f4").astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_pydict({
                "name": list(sums), "n": pa.array([n for n, _ in sums.values()], pa.int64()), "data": [x.tobytes() for _, x in sums.values()]})

    schema = "name string, n bigint, data binary"
    rows = docs.select(text).mapInArrow(train, schema).repartition(len(start), "name").mapInArrow(add, schema).collect()
    found = {r.name: (np.frombuffer(r.data, "<f8") / r.n).astype(np.float32).reshape(start[r.name].shape) for r in rows}
    return found or start


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> Model:
    counts = staged(word_counts(docs, text), "lm-counts")
    size = max(SIZE, math.isqrt(counts.count()))
    top = counts.orderBy(F.col("n").desc(), "word").limit(size - HASHED).collect()
    vocabulary = {r.word: k for k, r in enumerate(top)}
    rare = [0] * HASHED
    for r in counts.groupBy(_bucket().alias("bucket")).agg(F.sum("n").alias("n")).collect():
        rare[r.bucket] += r.n
    for r in top:
        rare[zlib.crc32(r.word.encode()) % HASHED] -= r.n
    model = Model(vocabulary, new_weights(classes_of(vocabulary)), counts, rare)
    for _ in range(rounds):
        model = model._replace(weights=_trained(docs, text, model))
    return model


def _bucket() -> Column:
    return F.pmod(F.crc32(F.encode("word", "UTF-8")), F.lit(HASHED)).cast("int")


def _scored_chunks(rows: DataFrame, vocabulary: dict[str, int], weights: dict[str, np.ndarray]) -> DataFrame:
    """A row of each chunk: scores by word or bucket, the chunk's distinct rare words, and how many each document
    has, which and how often."""
    size = classes_of(vocabulary) * MEMBERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(gathered(batches, CHUNK_BYTES)):
            words, ids, coded, counts = _coded(batch.column("text"), vocabulary)
            own = ids.astype(np.uint16 if size < 1 << 16 else np.int32)[coded]
            before = np.concatenate([[0.0], np.cumsum(log_probabilities(weights, own, _around(own, counts, size)))])
            ends = np.cumsum(counts)
            rare = np.flatnonzero(ids >= size - HASHED)
            place = np.full(len(ids), -1)
            place[rare] = np.arange(len(rare))
            text, asked = np.repeat(np.arange(len(counts)), counts), place[coded]
            pairs, n = np.unique(text[asked >= 0] * max(1, len(rare)) + asked[asked >= 0], return_counts=True)
            of, word = np.divmod(pairs, max(1, len(rare)))
            occurrences = squeeze(np.bincount(of, minlength=len(counts)).astype("<i4"), word.astype("<i4"), n.astype("<i4"))
            columns = [
                batch.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(before[ends] - before[ends - counts]),
                words.take(pa.array(rare)).cast(pa.string())]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) + number], pa.int64()), *lists, pa.array([occurrences], pa.binary())],
                names=["chunk", "doc_id", "n_tokens", "log_likelihood", "words", "occurrences"])

    return staged(rows.mapInArrow(run, CHUNK), "lm-chunks")


def _with_shares(chunks: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a chunk, with the logarithms of their rare words' shares added."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_likelihood", pa.float64())])
    if not len(chunks):
        return schema.empty_table()
    doc_id, n_tokens, scores = (chunks.column(c)[0].values for c in ("doc_id", "n_tokens", "log_likelihood"))
    words, word, n = unsqueeze(chunks.column("occurrences")[0].as_py())
    shares = np.zeros(len(answers))
    shares[answers.column("word").to_numpy()] = answers.column("share").to_numpy()
    more = np.bincount(np.repeat(np.arange(len(words)), words), n * shares[word], len(words))
    return pa.Table.from_arrays([doc_id, n_tokens, pa.array(scores.to_numpy() + more)], schema=schema)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_likelihood (the sum) and mean_log_likelihood (NULL without words) of every row."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    chunks = _scored_chunks(rows, model.vocabulary, model.weights)
    asked = chunks.select("chunk", F.posexplode("words").alias("place", "word"))
    total = F.element_at(F.array(*[F.lit(float(n + 1)) for n in model.rare]), _bucket() + 1)
    answers = asked.join(model.counts, "word", "left").select(
        F.col("chunk").alias("of"), F.col("place").alias("word"), F.log(F.coalesce("n", F.lit(1)) / total).alias("share"))
    scored = chunks.drop("words").groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(
        _with_shares, "doc_id bigint, n_tokens bigint, log_likelihood double")
    return scored.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
