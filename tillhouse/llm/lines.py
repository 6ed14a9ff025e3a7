"""Line deduplication: lines that many documents share stay in one of them only.

A line's key is the line without white space at both ends, A-Z in lower case. A key of at least ``min_chars`` code points
that at least ``min_docs`` documents hold is common: only the document with the largest id keeps its lines.

1. Texts are cut into lines where they are read; a long enough line becomes 128 bits of hash, its document and position.
2. These rows are range-partitioned by hash and, within a hash, by document (largest first) and position, so a line that
   a third of all documents hold is cut into many ranges instead of landing in one task.
3. A task streams its sorted range. The first document of a hash is the one that keeps it; the others lose their line as
   soon as enough documents were seen. Only the first and the last hash of a range may go on in a neighbouring one: their
   few largest documents are put together, two rows a range, and answer the rows that had to wait.
4. What a document loses becomes a compressed bitmap, a bit for each of its lines. Only bitmaps meet the texts again.

Defined results: a NULL or empty text is one empty line; documents are told apart by their id, so rows with the same id
count once and are the largest together; rows with a NULL id lose nothing and count against none; lines that a document
repeats go or stay together; an empty table gives an empty result; other columns are kept by ``deduplicated_rows`` and
ignored otherwise. Two rows of the same id whose texts agree in a 64-bit hash are taken as equal, as are keys that agree
in 128 bits.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import fresh, shuffle_partitions
from tillhouse.session import staged

MIN_CHARS = 40
MIN_DOCS = 5
BLANKS = "\t\n\v\f\r "

DROPPED, WAITING, SUMMARY = 0, 1, 2  # kinds of rows
LINE = "h1 bigint, h2 bigint, doc_id bigint, text_hash bigint, line int, n_lines int"
KEYS = ("h1", "h2")


def _rows(table: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in table.values()], names=list(table))


def hash_lines(batch: pa.RecordBatch, min_chars: int) -> pa.RecordBatch:
    """The long enough lines of a batch (doc_id, text_hash, text), each row that repeats another one left out."""
    import xxhash

    doc, text_hash = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    first = np.unique(np.stack([doc, text_hash], 1), axis=0, return_index=True)[1] if len(doc) else np.zeros(0, np.int64)
    cut = pc.split_pattern(batch.column(2).take(pa.array(np.sort(first))), "\n")
    sizes = np.diff(cut.offsets.to_numpy())
    owner = np.repeat(np.sort(first), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    trimmed = pc.utf8_trim(cut.flatten(), characters=BLANKS)
    long = np.flatnonzero(pc.greater_equal(pc.utf8_length(trimmed), min_chars).to_numpy(zero_copy_only=False))
    keys = pc.ascii_lower(trimmed.take(pa.array(long))).cast(pa.binary()).to_pylist()
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">i8").reshape(-1, 2).astype(np.int64)
    owner = owner[long]
    total = np.zeros(len(doc), np.int32)
    total[np.sort(first)] = sizes
    return _rows({"h1": digests[:, 0], "h2": digests[:, 1], "doc_id": doc[owner], "text_hash": text_hash[owner],
                  "line": place[long].astype(np.int32), "n_lines": total[owner]})


class LineStream:
    """Decides the rows of one sorted range, batch by batch, with bounded state.

    State is the open hash, its ``min_docs`` largest documents, and the rows of these that wait for more documents.
    """

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.key: tuple[int, int] | None = None
        self.at_start = True  # the open hash may have begun in the range before
        self.docs: list[int] = []
        self.waiting: list[dict[str, np.ndarray]] = []

    def feed(self, rows: dict[str, np.ndarray]) -> Iterator[tuple[int, dict[str, np.ndarray], list[int] | None]]:
        h1, h2 = rows["h1"], rows["h2"]
        edges = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
        starts = np.concatenate([[0], edges, [len(h1)]])
        yield from self._continue({k: v[:starts[1]] for k, v in rows.items()})
        if len(starts) > 3:  # hashes that begin and end in this batch
            yield from self._close()
            inner = {k: v[starts[1]:starts[-2]] for k, v in rows.items()}
            yield DROPPED, self._decide(inner, starts[1:-1] - starts[1]), None
        if len(starts) > 2:
            yield from self._continue({k: v[starts[-2]:] for k, v in rows.items()})

    def _decide(self, rows: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        sizes = np.diff(starts)
        new = np.concatenate([[True], rows["doc_id"][1:] != rows["doc_id"][:-1]])
        new[starts[:-1]] = True
        seen = np.cumsum(new)
        nth = seen - np.repeat(seen[starts[:-1]] - 1, sizes)
        documents = np.repeat(nth[starts[1:] - 1], sizes)
        lost = (documents >= self.min_docs) & (nth > 1)
        return {k: v[lost] for k, v in rows.items()}

    def _continue(self, rows: dict[str, np.ndarray]):
        key = int(rows["h1"][0]), int(rows["h2"][0])
        if key != self.key:
            yield from self._close()
            self.key = key
        doc = rows["doc_id"]
        for d in doc[np.concatenate([[True], doc[1:] != doc[:-1]])][:self.min_docs + 1]:
            if len(self.docs) < self.min_docs and (not self.docs or self.docs[-1] != d):
                self.docs.append(int(d))
        if self.at_start:
            yield WAITING, rows, None
        elif len(self.docs) < self.min_docs:
            self.waiting.append(rows)
        else:
            for part in (*self.waiting, rows):
                yield DROPPED, {k: v[part["doc_id"] != self.docs[0]] for k, v in part.items()}, None
            self.waiting = []

    def _close(self, last: bool = False):
        if self.key is not None and (self.at_start or last):
            for part in self.waiting:
                yield WAITING, part, None
            summary = {k: np.array([v]) for k, v in zip(KEYS, self.key)}
            yield SUMMARY, summary, self.docs
        if self.key is not None:
            self.at_start = False
        self.key, self.docs, self.waiting = None, [], []

    def end(self):
        yield from self._close(last=True)


_STREAMED = "kind int, " + LINE + ", docs array<bigint>"


def _streamed(kind: int, rows: dict[str, np.ndarray], docs: list[int] | None) -> pa.RecordBatch:
    n = len(rows["h1"])
    kinds = {"h1": pa.int64(), "h2": pa.int64(), "doc_id": pa.int64(), "text_hash": pa.int64(), "line": pa.int32(), "n_lines": pa.int32()}
    arrays = [pa.array(np.full(n, kind, np.int32))]
    arrays += [pa.array(rows[k]) if k in rows else pa.nulls(n, t) for k, t in kinds.items()]
    arrays.append(pa.array([docs], pa.list_(pa.int64())) if docs is not None else pa.nulls(n, pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays(arrays, names=["kind", *kinds, "docs"])


def _stream_range(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = LineStream(min_docs)
        for batch in batches:
            if batch.num_rows:
                rows = {n: batch.column(i).to_numpy() for i, n in enumerate(batch.schema.names)}
                for piece in stream.feed(rows):
                    if len(piece[1]["h1"]):
                        yield _streamed(*piece)
        for piece in stream.end():
            yield _streamed(*piece)

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for n, lost in zip(batch.column(2).to_pylist(), batch.column(3)):
            keep = np.ones(n, bool)
            keep[lost.values.to_numpy()] = False
            out.append(zlib.compress(np.packbits(keep).tobytes(), 6))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], names=["doc_id", "text_hash", "n_lines", "keep"])


def unpack(keep: bytes, n_lines: int) -> np.ndarray:
    """A keep bitmap as booleans, one for each line."""
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines).view(bool)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text_hash (of the text, by ``xxhash64``), n_lines and keep (see ``unpack``) of documents that lose lines."""
    if min_docs < 2:
        raise ValueError("a line of a single document has no other to stay in")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    lines = staged(texts.filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(
        lambda batches: (hash_lines(b, min_chars) for b in batches), LINE), "lines")
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc(), F.col("text_hash"), F.col("line")]
    ranges = lines.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    streamed = staged(ranges.mapInArrow(_stream_range(min_docs), _STREAMED), "line-ranges")
    # At most two hashes a range, each with its few largest documents.
    edges = streamed.filter(F.col("kind") == SUMMARY).select(*KEYS, F.explode("docs").alias("d")).groupBy(*KEYS).agg(
        F.countDistinct("d").alias("c"), F.max("d").alias("last")).filter(F.col("c") >= min_docs)
    lost = ["doc_id", "text_hash", "n_lines", "line"]
    answered = streamed.filter(F.col("kind") == WAITING).join(F.broadcast(edges), list(KEYS)).filter("doc_id <> last").select(lost)
    dropped = streamed.filter(F.col("kind") == DROPPED).select(lost).union(answered)
    return dropped.groupBy("doc_id", "text_hash", "n_lines").agg(F.collect_list("line").alias("lost")).mapInArrow(
        _bitmaps, "doc_id bigint, text_hash bigint, n_lines int, keep binary")


def _met(docs: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, str]:
    """Documents with the bitmap of their lost lines, NULL where they lose none, and that column's name."""
    keep, text_hash, key = (fresh(docs, n) for n in ("keep", "text_hash", "line_key"))
    known = bitmaps.select(F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash), F.col("keep").alias(keep))
    on = (docs["doc_id"].cast("bigint") == known[key]) & (F.xxhash64(docs["text"]) == known[text_hash])
    return docs.join(known, on, "left").drop(key, text_hash), keep


def _kept(text: bytes | None, keep: bytes | None) -> tuple[int, int, bytes]:
    """Lines, lines dropped, and what is left of a text."""
    text = text or b""
    n = text.count(b"\n") + 1
    if keep is None:
        return n, 0, text
    left = [line for line, stays in zip(text.split(b"\n"), unpack(keep, n)) if stays]
    return n, n - len(left), b"\n".join(left)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_kept(*row) for row in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()),
             pa.array([hashlib.sha256(x[2]).hexdigest() for x in found], pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def kept_digest(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every row."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    met, keep = _met(own, keep_bitmaps(own, min_chars, min_docs))
    return met.select("doc_id", F.col("text").cast("binary"), keep).mapInArrow(
        _digest, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")


def deduplicated_rows(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows with what is left of their texts; rows that lose nothing stay as they are, NULL included."""
    met, keep = _met(docs, keep_bitmaps(docs, min_chars, min_docs))

    @F.pandas_udf("string")
    def cut(texts, keeps):
        import pandas as pd

        return pd.Series([t if k is None else _kept(t.encode(), k)[2].decode() for t, k in zip(texts, keeps)], dtype=object)

    text = F.when(F.col(keep).isNull(), F.col("text")).otherwise(cut("text", keep))
    return met.withColumn("text", text).select(docs.columns)
