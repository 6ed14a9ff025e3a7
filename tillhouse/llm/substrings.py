"""Substring deduplication: words in passages that a document with a smaller id has too are removed.

Every window of ``window`` words gets a Rabin-Karp hash: words are numbers, the window is their polynomial, and the
hashes of all windows of many texts come from one running sum. Windows are counted by hash in Spark, where the smallest
doc_id of each is found. A window of a document is repeated if that id is smaller; repeated windows that overlap or
touch merge into the maximal intervals that are removed.

1. Texts are hashed in chunks. Within a chunk a hash is combined to its smallest document, so a passage that a third of
   all documents share is sent once for each chunk; the other documents of the chunk are known to repeat it.
2. Hashes go to the task of their range, packed in sorted blocks of differences (some seven bytes a window). The task
   finds the chunks' documents that aren't the smallest.
3. What a document repeats, as hashes, meets its text, which finds the places again.

Hashes have 64 bits. At 10^12 windows a false match is still expected for one window in 10^7 only.

Defined results: windows are judged on the input; a document doesn't count against itself or rows with the same id; a
NULL text has no words; texts shorter than a window lose nothing; rows with a NULL id keep all words and count against
none; an empty table gives an empty result; other columns are kept where they are asked for.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.blocks import squeeze, unsqueeze
from tillhouse.llm.common import giving_back, shuffle_partitions

WINDOW = 50
CHUNK_BYTES = 8 << 20  # of text
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
SEED = 42  # of Spark's own xxhash64

HASHES, REPEATS = 0, 1  # kinds of rows
CUT = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:int,stop:int>>, kept_text string"
ROW = "target int, kind int, data binary"


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    words, offsets = lists.values, lists.offsets.to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), np.diff(before[offsets])


def window_hashes(words: pa.Array, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word (number within all words) of every window."""
    import xxhash

    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none.view(np.uint64), none, none
    coded = words.dictionary_encode()
    values = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    n = len(words)
    powers = np.full(n, BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[coded.indices.to_numpy()] * powers, out=sums[1:])
    text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    start = np.flatnonzero(text[: n - window + 1] == text[window - 1:])
    powers = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    hashes = (sums[start + window] - sums[start]) * powers[start]
    hashes ^= hashes >> np.uint64(31)  # spread what the low bits hold
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    return hashes, text[start], start


def _home(doc_id: int, parts: int) -> int:
    """The task of a document, as Spark's pmod(xxhash64(doc_id), parts)."""
    import xxhash

    value = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), SEED)
    return (value - (1 << 64) if value >> 63 else value) % parts


def _row(target: int, kind: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([target], pa.int32()), pa.array([kind], pa.int32()), pa.array([data], pa.binary())], names=["target", "kind", "data"])


def _repeats(doc_ids: np.ndarray, hashes: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Pairs of document and repeated hash, dealt to the documents' tasks."""
    if not len(doc_ids):
        return
    distinct, place = np.unique(doc_ids, return_inverse=True)
    home = np.fromiter((_home(int(d), parts) for d in distinct), np.int32, len(distinct))
    order = np.lexsort((hashes, place, home[place]))
    place, hashes = place[order], hashes[order]
    stops = np.searchsorted(home[place], np.arange(parts + 1))
    for part in np.flatnonzero(np.diff(stops)):
        docs, counts = np.unique(distinct[place[stops[part]:stops[part + 1]]], return_counts=True)
        own = hashes[stops[part]:stops[part + 1]]
        yield _row(int(part), REPEATS, squeeze(docs.astype("<i8"), counts.astype("<u4"), np.diff(own, prepend=np.uint64(0))))


def _hash_chunks(batches: Iterator[pa.RecordBatch], window: int, buckets: int, parts: int) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches):
        chunk = chunk.sort_by("doc_id")
        words, counts = word_lists(chunk.column("text").combine_chunks())
        hashes, text, _ = window_hashes(words, counts, window)
        doc_ids = chunk.column("doc_id").to_numpy()
        order = np.argsort(hashes, kind="stable")  # documents stay in order below each hash
        hashes, text = hashes[order], text[order]
        new = np.concatenate([np.ones(min(1, len(hashes)), bool), hashes[1:] != hashes[:-1]])
        run = np.cumsum(new) - 1
        later = doc_ids[text] > doc_ids[text[new]][run]
        pair = later & np.concatenate([np.ones(min(1, len(hashes)), bool), (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])
        yield from _repeats(doc_ids[text[pair]], hashes[pair], parts)
        hashes, text = hashes[new], text[new]
        stops = np.searchsorted(_bucket(hashes, buckets), np.arange(buckets + 1))
        for bucket in np.flatnonzero(np.diff(stops)):
            some = slice(stops[bucket], stops[bucket + 1])
            held, place = np.unique(text[some], return_inverse=True)
            yield _row(int(bucket), HASHES, squeeze(
                doc_ids[held].astype("<i8"), place.astype("<u4"), np.diff(hashes[some], prepend=np.uint64(0))))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _count(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Finds the smallest document of every hash of the task; what chunks have found repeated passes."""
    hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for batch in batches:
        for target, kind, data in zip(*(batch.column(c).to_pylist() for c in ("target", "kind", "data"))):
            if kind == REPEATS:
                yield _row(target, kind, data)
                continue
            doc_ids, place, steps = unsqueeze(data)
            hashes.append(np.cumsum(steps, dtype=np.uint64))
            docs.append(doc_ids[place])
    hashes, docs = np.concatenate(hashes), np.concatenate(docs)
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    shared = np.flatnonzero(hashes[1:] == hashes[:-1])
    if not len(shared):
        return
    shared = np.unique(np.concatenate([shared, shared + 1]))
    hashes, docs = hashes[shared], docs[shared]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    least = np.repeat(np.minimum.reduceat(docs, starts), np.diff(starts, append=len(docs)))
    yield from _repeats(docs[docs > least], hashes[docs > least], parts)


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows of repeats come before the documents."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    pairs = None
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        if (kinds == REPEATS).any():
            for data in batch.column("data").filter(pa.array(kinds == REPEATS)).to_pylist():
                docs, counts, steps = unsqueeze(data)
                found.append((np.repeat(docs, counts), np.cumsum(steps, dtype=np.uint64)))
            batch = batch.filter(pa.array(kinds != REPEATS))
        if not batch.num_rows:
            continue
        if pairs is None:
            pairs = _by_document(found)
        yield _judged(batch, pairs, window)


def _by_document(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, where the hashes of each start (with the end), and the hashes."""
    docs = np.concatenate([np.zeros(0, np.int64), *(d for d, _ in found)])
    hashes = np.concatenate([np.zeros(0, np.uint64), *(h for _, h in found)])
    order = np.argsort(docs, kind="stable")
    docs, starts = np.unique(docs[order], return_index=True)
    return docs, np.append(starts, len(order)), hashes[order]


def _judged(batch: pa.RecordBatch, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], window: int) -> pa.RecordBatch:
    docs, starts, repeated = pairs
    words, counts = word_lists(batch.column("text"))
    ends = np.cumsum(counts)
    removed = np.zeros(len(words), bool)
    ids = batch.column("doc_id")
    number = np.searchsorted(docs, ids.fill_null(0).to_numpy())
    known = ids.is_valid().to_numpy(zero_copy_only=False) & (number < len(docs))
    known[known] = docs[number[known]] == ids.fill_null(0).to_numpy()[known]
    for k in np.flatnonzero(known & (counts >= window)):
        first = ends[k] - counts[k]
        hashes, _, at = window_hashes(words.slice(int(first), int(counts[k])), counts[k:k + 1], window)
        hit = first + at[np.isin(hashes, repeated[starts[number[k]]:starts[number[k] + 1]])]
        if len(hit):
            change = np.zeros(counts[k] + 1, np.int32)
            np.add.at(change, hit - first, 1)
            np.add.at(change, hit - first + window, -1)
            removed[first:ends[k]] = np.cumsum(change)[:-1] > 0
    before = np.concatenate([[0], np.cumsum(removed)])
    gone = before[ends] - before[ends - counts]
    text = np.repeat(np.arange(len(counts)), counts)
    opens, closes = _spans(removed, text)
    spans = np.bincount(text[opens], minlength=len(counts))
    base = (ends - counts)[text[opens]]
    kept_ends = np.concatenate([[0], np.cumsum(counts - gone)]).astype(np.int32)
    kept = pa.ListArray.from_arrays(pa.array(kept_ends), words.filter(pa.array(~removed)).cast(pa.string()))
    struct_type = pa.StructArray.from_arrays(
        [pa.array((opens - base).astype(np.int32)), pa.array((closes - base).astype(np.int32))], names=["start", "stop"])
    out = [
        ids, pa.array(counts.astype(np.int64)), pa.array(gone.astype(np.int64)),
        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(spans)]).astype(np.int32)), struct_type),
        pc.binary_join(kept, " "), batch.column("row"),
    ]
    return pa.RecordBatch.from_arrays(out, names=["doc_id", "n_words", "n_removed", "spans", "kept_text", "row"])


def _spans(removed: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the maximal removed runs within a text, and the words after them."""
    if not len(removed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = text[1:] == text[:-1]
    opens = removed & ~np.concatenate([[False], removed[:-1] & same])
    closes = removed & ~np.concatenate([removed[1:] & same, [False]])
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, keep: Sequence[str] = (),
) -> DataFrame:
    """For each row of ``docs``: doc_id, n_words, n_removed, spans (removed intervals of words), kept_text (the other
    words, joined by spaces) and row (a struct of the columns in ``keep``)."""
    parts = shuffle_partitions(docs.sparkSession)
    buckets = 2 * parts
    one = F.col(doc_id).cast("bigint")
    texts = docs.select(one.alias("doc_id"), F.col(text).alias("text"))
    known = texts.filter("doc_id IS NOT NULL")
    hashed = known.mapInArrow(giving_back(lambda it: _hash_chunks(it, window, buckets, parts)), ROW)
    repeats = hashed.repartitionById(buckets, F.col("target")).mapInArrow(giving_back(lambda it: _count(it, parts)), ROW)
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("row")
    home = F.pmod(F.when(one.isNull(), F.xxhash64(F.col(text))).otherwise(F.xxhash64(one)), F.lit(parts)).cast("int")
    whole = docs.select(
        home.alias("target"), F.lit(REPEATS + 1).alias("kind"), F.lit(None).cast("binary").alias("data"),
        one.alias("doc_id"), F.col(text).alias("text"), row)
    repeats = repeats.select(
        "target", "kind", "data", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast(whole.schema["row"].dataType).alias("row"))
    met = repeats.union(whole).repartitionById(parts, F.col("target")).sortWithinPartitions("kind")
    out = T.StructType.fromDDL(CUT).add("row", whole.schema["row"].dataType)
    return met.drop("target").mapInArrow(giving_back(lambda it: _cut(it, window)), out)


def kept_digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def deduplicated_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with all their columns; texts that lose words are what is left of them, others unchanged."""
    cut = deduplicate(docs, doc_id, text, window, docs.columns)
    left = F.when(F.col("n_removed") == 0, F.col("row").getField(text)).otherwise(F.col("kept_text"))
    return cut.select(*[(left if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])
