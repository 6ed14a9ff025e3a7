"""Byte-level BPE: every distinct pre-token of the corpus is encoded once.

1. Texts are cut into pre-tokens in chunks of some ten megabytes. A chunk keeps its pre-tokens in order as numbers into
   its own list of distinct words (the positions), and sends these words, packed, to the task of their hash.
2. There each distinct word of the whole corpus is encoded once, and the ids go back to the chunks that asked for them.
3. The chunk's positions are filled in with the ids. Decoding joins ids with the table of token bytes.

A frequent word is sent once for each chunk, whatever its count, so no word makes a task hot; the table of a task holds
the distinct words of one hash bucket. Positions and words travel as compressed blocks.

A pre-token never spans from other characters into white space, and of white space before a word it holds one space at
most. So a text without a space after other white space can be cut at its spaces, and the pattern need only run on
distinct pieces; other texts are matched whole. Both give the matches of the pattern on the text.

Defined results: a NULL or empty text has no ids; rows repeated in full are encoded each; a NULL id stays NULL; an empty
table gives an empty result; other columns are ignored. ``docs`` should be a table, as chunks are counted within the
partitions in which it is read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.blocks import squeeze, unsqueeze
from tillhouse.llm.common import giving_back, shuffle_partitions

CHUNK_BYTES = 8 << 20  # of text, about
# A space that follows white space of any kind (a superset of what the pattern takes for it).
SPACE_AFTER_SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}] "

# A row is a block of words for a bucket, or with bucket -1 the positions of a chunk. ``target`` is the bucket of words,
# as a negative number, or the chunk of positions.
ROW = "target bigint, chunk bigint, bucket int, data binary"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _gather(values: np.ndarray, lengths: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` (of these lengths) that ``picks`` names, joined, and where each starts, with the end."""
    counts = lengths[picks]
    ends = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat((np.cumsum(lengths) - lengths)[picks] - ends[:-1], counts)
    at += np.arange(ends[-1])
    return values[at], ends


def pre_tokens(texts: pa.Array, findall) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens, all pre-tokens as numbers into these, and how many each text has."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    whole = pc.match_substring_regex(texts, SPACE_AFTER_SPACE)
    lists = pc.split_pattern(pc.if_else(whole, "", texts), " ")
    offsets = lists.offsets.to_numpy()
    coded = lists.values.dictionary_encode()
    units = coded.indices.to_numpy().astype(np.int32)
    pieces: list[list[str]] = [findall(" " + u) for u in coded.dictionary.to_pylist()]
    openings = pc.if_else(whole, texts, lists.values.take(pa.array(offsets[:-1]))).dictionary_encode()
    units[offsets[:-1]] = len(pieces) + openings.indices.to_numpy()
    pieces += map(findall, openings.dictionary.to_pylist())
    place: dict[str, int] = {}
    number = place.setdefault
    flat = np.fromiter((number(w, len(place)) for p in pieces for w in p), np.int32)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    codes, ends = _gather(flat, lengths, units)
    return list(place), codes, np.diff(ends[offsets])


def _tokenise(batches: Iterator[pa.RecordBatch], pattern: str, buckets: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    import regex

    findall = regex.compile(pattern).findall
    part = TaskContext.get().partitionId()
    for number, chunk in enumerate(_chunks(batches, chunk_bytes)):
        words, codes, counts = pre_tokens(chunk.column("text").combine_chunks(), findall)
        frequent_first = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), "<u4")
        rank[frequent_first] = np.arange(len(words))
        data = [words[i].encode() for i in frequent_first]
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in data), np.int64, len(data))
        sent = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[sent], np.arange(buckets + 1))
        name = (part << 24) + number
        ids = chunk.column("doc_id").combine_chunks()
        place = np.empty(len(words), "<u4")
        place[sent] = np.arange(len(words))
        body = squeeze(
            ids.fill_null(0).to_numpy().astype("<i8"), ids.is_valid().to_numpy(zero_copy_only=False).astype("u1"),
            counts.astype("<u4"), place, rank[codes],
        )
        yield _row(name, name, -1, body)
        for b in np.flatnonzero(np.diff(bounds)):
            some = [data[i] for i in sent[bounds[b]:bounds[b + 1]]]
            lengths = np.fromiter(map(len, some), "<u4", len(some))
            yield _row(-1 - int(b), name, int(b), squeeze(lengths, np.frombuffer(b"".join(some), "u1")))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= chunk_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _row(target: int, chunk: int, bucket: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([target], pa.int64()), pa.array([chunk], pa.int64()), pa.array([bucket], pa.int32()), pa.array([data], pa.binary())],
        names=["target", "chunk", "bucket", "data"])


def _encode_words(batches: Iterator[pa.RecordBatch], ranks_path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    import tiktoken

    coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})
    known: dict[bytes, list[int]] = {}  # the distinct words of this task's buckets
    for batch in batches:
        words = batch.filter(pc.greater_equal(batch.column("bucket"), 0))
        for chunk, bucket, data in zip(words.column("chunk").to_pylist(), words.column("bucket").to_pylist(), words.column("data")):
            lengths, joined = unsqueeze(data.as_py())
            text, ends = joined.tobytes(), np.cumsum(lengths.astype(np.int64)).tolist()
            lists, at = [], 0
            for end in ends:
                word = text[at:end]
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = coder.encode_ordinary(word.decode())
                lists.append(ids)
                at = end
            counts = np.fromiter(map(len, lists), "<u4", len(lists))
            ids = np.fromiter((i for ids in lists for i in ids), "<u4", int(counts.sum()))
            yield _row(chunk, chunk, bucket, squeeze(counts, ids))


def _assemble(positions: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a chunk; a group of words, which meets no answers, has none."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    own = positions.filter(pc.less(positions.column("bucket"), 0)).column("data")
    if not len(own):
        return schema.empty_table()
    doc_ids, has_id, counts, place, codes = unsqueeze(own[0].as_py())
    blocks = [unsqueeze(x.as_py()) for x in answers.sort_by("bucket").column("data")]
    lengths = np.concatenate([np.zeros(0, "<u4"), *(b[0] for b in blocks)])
    values = np.concatenate([np.zeros(0, "<u4"), *(b[1] for b in blocks)]).view(np.int32)
    tokens, ends = _gather(values, lengths.astype(np.int64), place[codes])
    offsets = ends[np.concatenate([[0], np.cumsum(counts.astype(np.int64))])].astype(np.int32)
    return pa.Table.from_arrays(
        [pa.array(doc_ids, mask=has_id == 0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens))], schema=schema)


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """doc_id and ids (array of int) for each row of ``docs``.

    One shuffle deals words to their buckets and positions to their chunks; the answers are shuffled to the chunks, which
    wait in place.
    """
    buckets = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    asked = rows.mapInArrow(giving_back(lambda it: _tokenise(it, pattern, buckets, chunk_bytes)), ROW).repartition(buckets, "target")
    answers = asked.mapInArrow(giving_back(lambda it: _encode_words(it, ranks_path, pattern)), ROW)
    return asked.groupBy("target").cogroup(answers.groupBy("chunk")).applyInArrow(_assemble, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds the decoded bytes to ``encoded`` (doc_id, ids)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_bytes = {rank: token for token, rank in read_ranks(ranks_path).items()}
        table = [token_bytes.get(i, b"") for i in range(max(token_bytes) + 1)]
        for batch in batches:
            lists = batch.column("ids")
            offsets, values = lists.offsets.to_pylist(), lists.values.to_pylist()
            data = [b"".join([table[i] for i in values[a:b]]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, pa.array(data, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(giving_back(join), "doc_id bigint, ids array<int>, decoded binary")


def ids_text(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ``more`` columns."""
    return decoded.select(
        "doc_id", *more, F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
