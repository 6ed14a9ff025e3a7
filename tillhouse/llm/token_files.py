"""Token ids in bit-packed files with random access.

A file holds the documents of a range of ids, in order. Each id takes as many bits as the vocabulary needs.

    magic            8 bytes
    blocks           BLOCK ids each (the last fewer), bit-packed from the most significant bit, padded to whole bytes
    doc ids          int64 for each document
    doc has id       uint8 for each document, 0 where the id is NULL
    doc starts       uint64 for each document and one for the end, in ids of this file
    block offsets    uint64 for each block and one for the end, in bytes of this file
    trailer          uint64 place of the doc ids, uint64 documents, uint64 blocks, uint32 bits, uint32 BLOCK, magic

Every block starts at a whole byte, so a reader unpacks one or many with numpy and reaches any id through its block.

Documents are encoded where they are read, by the ``tokenizers`` library. No piece of that tokenizer spans white space,
so each distinct word of a batch is encoded once and occurrences are filled in from a table. Words that the tokenizer's
normal form and pieces leave alone meet its model without these two steps. Only packed ids are shuffled, once, to the
shard of their id range. Files appear whole under names that depend on the data only.

Defined results: a NULL or empty text has the end id only; documents with NULL id come first; rows with the same id
follow each other in the order of their ids' bytes; an empty table gives no files and an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillhouse.llm.blocks import gathered
from tillhouse.llm.common import shuffle_partitions
from tillhouse.llm.files import id_bytes, open_input, range_bounds, shard_numbers, whole_file
from tillhouse.session import new_folder, staged

MAGIC = b"TOKBITS1"
BLOCK = 4096  # ids; a multiple of 8, so that full blocks end at a whole byte
TRAILER = "<QQQII8s"
TRAILER_BYTES = struct.calcsize(TRAILER)
WHOLE_BYTES = {8: "u1", 16: ">u2", 32: ">u4"}  # widths that need no bit by bit packing
WORD_END = "</w>"  # what the last token of a word ends with
CHUNK_BYTES = 8 << 20  # of text that is encoded together
SENT_BYTES = 2 << 20  # of ids that go back together, about
KNOWN_WORDS = 400_000  # words whose ids a task keeps; beyond that it starts afresh
JOINED = 100  # words that are encoded as one text
SMALL = "a-z\u00df-\u00f6\u00f8-\u00ff"  # letters that are their own normal form
SIMPLE = f"^[{SMALL}]+$"
LATIN = r"^[\x00-;=-\x7f\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]*$"  # may be lower-cased at once; "<" begins added tokens
STOPS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"  # not the quote, which begins pieces, nor what added tokens hold


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in WHOLE_BYTES:
        return ids.astype(WHOLE_BYTES[bits]).tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits:]).tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in WHOLE_BYTES:
        return np.frombuffer(data, WHOLE_BYTES[bits], count).astype(np.uint32)
    narrow = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits).reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - bits:] = narrow
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


def _letters(word: str) -> bool:
    """All letters, and still so in the tokenizer's normal form."""
    return word.isalpha() and (word.isascii() or (word.lower().isalpha() and unicodedata.is_normalized("NFC", word)))


class WordTable:
    """Ids of texts through a table of the words met so far."""

    def __init__(self, tokenizer_path: str, end_id: int | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(tokenizer_path), end_id
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.kind = np.dtype("<u2" if max(len(self.ends_word) - 1, end_id or 0) < 1 << 16 else "<u4")
        self.model_alone = self._model_alone()
        self._clear()

    def _model_alone(self):
        """A tokenizer that only splits at spaces, for words of ``SMALL`` letters; None if this one does more to them."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        split = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        letters = "".join(filter(re.compile(SIMPLE).match, map(chr, range(256))))
        probe = f"{letters} {letters[::-1]} {' '.join(letters)}"
        normal, pieces = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is not None and normal.normalize_str(probe) != probe:
            return None
        if pieces is None or [p for p, _ in pieces.pre_tokenize_str(probe)] != [p for p, _ in split.pre_tokenize_str(probe)]:
            return None
        if any(re.match(SIMPLE, t.content.lower()) for t in self.tokenizer.get_added_tokens_decoder().values()):
            return None
        alone = Tokenizer(self.tokenizer.model)
        alone.pre_tokenizer = split
        return alone

    def _clear(self) -> None:
        """``words`` and, at the same places, their ``ids``."""
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Adds words to the table and returns their places.

        Words of letters alone end with the one token that ends a word, so many of them are encoded as one text.
        """
        simple = pc.match_substring_regex(new, SIMPLE).to_numpy(zero_copy_only=False) & (self.model_alone is not None)
        kinds = np.where(simple, 0, 2)
        maybe = np.flatnonzero(pc.utf8_is_alpha(new).to_numpy(zero_copy_only=False) & ~simple)
        kinds[maybe] = [1 if _letters(w) else 2 for w in new.take(pa.array(maybe)).to_pylist()]
        words, ids = [self.words], [self.ids]
        for kind, at_once, encoded in ((0, 20_000, self._joined), (1, 20_000, self._joined), (2, 5_000, self._each)):
            some = new.filter(pa.array(kinds == kind))
            words.append(some)
            ids += [encoded(some[at:at + at_once], kind == 0) for at in range(0, len(some), at_once)]
        places = np.empty(len(new), np.int32)
        places[np.argsort(kinds, kind="stable")] = np.arange(len(self.words), len(self.words) + len(new))
        self.words, self.ids = pa.concat_arrays(words), pa.concat_arrays(ids)
        return places

    def _joined(self, words: pa.Array, simple: bool) -> pa.Array:
        starts = np.append(np.arange(0, len(words), JOINED), len(words)).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(starts, words), pa.scalar(" ", pa.large_string()))
        tokenizer = self.model_alone if simple else self.tokenizer
        lists = tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in lists), self.kind)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):  # another kind of tokenizer
            return self._each(words)
        return self._binary(ends, ids)

    def _each(self, words: pa.Array, simple: bool = False) -> pa.Array:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        return self._binary(ends, np.fromiter(chain.from_iterable(lists), self.kind))

    def _binary(self, ends: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The bytes of ids for each word, given where a word's ids end."""
        offsets = np.concatenate([[0], ends]).astype(np.int64) * self.kind.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])

    def _places(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct word the places of its core and of its trailing stops.

        Stops are cut off where a letter or digit comes before that the tokenizer leaves as it is, as they are a piece
        of their own there.
        """
        words = pc.if_else(pc.match_substring_regex(distinct, LATIN), pc.utf8_lower(distinct), distinct)
        cores = pc.ascii_rtrim(words, characters=STOPS)
        stopped = pc.less(pc.binary_length(cores), pc.binary_length(words))
        ends, cores = words.filter(stopped), cores.filter(stopped)
        apart = pc.match_substring_regex(cores, f"[0-9{SMALL}]$")
        words = pc.replace_with_mask(words, stopped, pc.if_else(apart, cores, ends))
        tails = pc.if_else(apart, pc.replace_substring_regex(ends, f"^.*[^{re.escape(STOPS)}]", ""), "")
        if len(self.words) > KNOWN_WORDS:
            self._clear()
        tail = np.full(len(words), self._found(pa.array([""], pa.large_string()))[0], np.int32)
        tail[stopped.to_numpy(zero_copy_only=False)] = self._found(tails)
        return self._found(words), tail

    def _found(self, names: pa.Array) -> np.ndarray:
        """Places of words in the table, which learns those that are new."""
        coded = names.dictionary_encode()
        known = pc.index_in(coded.dictionary, value_set=self.words)
        places = pc.fill_null(known, -1).to_numpy().copy()
        if known.null_count:
            places[places < 0] = self._learn(coded.dictionary.filter(known.is_null()))
        return places[coded.indices.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, end ids included, and the place where each text's ids start, with one more for the end."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        core, tail = self._places(coded.dictionary)
        names = pc.binary_join_element_wise(self.ids.take(pa.array(core)), self.ids.take(pa.array(tail)), pa.scalar(b"", pa.large_binary()))
        word = coded.indices.to_numpy()
        if self.end_id is not None:  # as one more word behind each text
            names = pa.concat_arrays([names, pa.array([np.array(self.end_id, self.kind).tobytes()], pa.large_binary())])
            word = np.insert(word, offsets[1:], len(names) - 1)
            offsets += np.arange(len(offsets))
        if not len(word):
            return np.zeros(0, self.kind), offsets
        _, ends, data = names.take(pa.array(word)).buffers()
        starts = np.frombuffer(ends, np.int64, len(word) + 1)[offsets] // self.kind.itemsize
        return np.frombuffer(data or b"", self.kind, int(starts[-1])), starts


def encoded(
    docs: DataFrame, doc_id: str, text: str, tokenizer_path: str, end_id: int | None, wide: bool, bounds: list[int],
) -> DataFrame:
    """doc_id, the ids as little-endian 16-bit (``wide``: 32-bit) integers and the shard of the doc_id."""
    kind, edges = np.dtype("<u4" if wide else "<u2"), np.array(bounds, np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(tokenizer_path, end_id)
        for batch in gathered(batches, CHUNK_BYTES):
            ids, starts = table.encode(batch.column(1))
            data = pa.py_buffer(ids.astype(kind, copy=False))
            shards = shard_numbers(edges, batch.column(0))
            offsets = starts * kind.itemsize
            step = max(1, batch.num_rows // (1 + int(offsets[-1]) // SENT_BYTES))
            for at in range(0, batch.num_rows, step):  # back in pieces that a JVM task holds easily
                part = offsets[at:at + step + 1]
                own = data.slice(int(part[0]), int(part[-1] - part[0]))
                packed = pa.Array.from_buffers(pa.binary(), len(part) - 1, [None, pa.py_buffer((part - part[0]).astype(np.int32).tobytes()), own])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, step), packed, shards.slice(at, step)], names=["doc_id", "ids", "shard"])
            del ids, data, own, packed
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "doc_id bigint, ids binary, shard int")


class _Writer:
    """One file."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.at = out.write(MAGIC)
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.starts, self.blocks = [0], []
        self.doc_ids: list[int] = []
        self.has_id: list[bool] = []

    def _blocks(self, count: int) -> None:
        """Writes the first ``count`` of the ids held."""
        held, size = np.concatenate(self.held), BLOCK * self.bits // 8
        data = pack(held[:count], self.bits)
        self.blocks += range(self.at, self.at + len(data), size)
        self.at += len(data)
        self.out.write(data)
        self.held, self.n_held = [held[count:]], len(held) - count

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id or 0)
        self.has_id.append(doc_id is not None)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= 64 * BLOCK:
            self._blocks(self.n_held // BLOCK * BLOCK)

    def close(self) -> None:
        if self.n_held:
            self._blocks(self.n_held)
        for values, kind in ((self.doc_ids, "<i8"), (self.has_id, "u1"), (self.starts, "<u8"), ([*self.blocks, self.at], "<u8")):
            self.out.write(np.array(values, dtype=kind).tobytes())
        self.out.write(struct.pack(TRAILER, self.at, len(self.doc_ids), len(self.blocks), self.bits, BLOCK, MAGIC))


class TokenFile:
    """Random access to one file: its index in memory, ids on demand."""

    def __init__(self, path: str):
        self.file = open_input(path)
        size = self.file.size()
        index, docs, blocks, self.bits, self.block, magic = struct.unpack(TRAILER, self._bytes(size - TRAILER_BYTES, TRAILER_BYTES))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        data = self._bytes(index, size - TRAILER_BYTES - index)
        self.doc_ids = np.frombuffer(data, "<i8", docs)
        self.has_id = np.frombuffer(data, "u1", docs, 8 * docs).astype(bool)
        self.starts = np.frombuffer(data, "<u8", docs + 1, 9 * docs).astype(np.int64)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, 17 * docs + 8).astype(np.int64)

    def _bytes(self, at: int, count: int) -> bytes:
        self.file.seek(at)
        return self.file.read(count)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids number ``first`` to ``last`` - 1 of the file."""
        if first >= last:
            return np.zeros(0, np.uint32)
        low, high = first // self.block, (last - 1) // self.block + 1
        data = self._bytes(int(self.offsets[low]), int(self.offsets[high] - self.offsets[low]))
        held = min(high * self.block, int(self.starts[-1])) - low * self.block
        return unpack(data, held, self.bits)[first - low * self.block:last - low * self.block]

    def document(self, place: int) -> np.ndarray:
        return self.ids(int(self.starts[place]), int(self.starts[place + 1]))

    def documents(self, at_once: int = 256 * BLOCK) -> Iterator[tuple[int, np.ndarray]]:
        """Place and ids of all documents, read in long runs."""
        place = 0
        while place < len(self.doc_ids):
            last = max(place + 1, int(np.searchsorted(self.starts, self.starts[place] + at_once, side="right")) - 1)
            run = self.ids(int(self.starts[place]), int(self.starts[last]))
            for k in range(place, last):
                yield k, run[self.starts[k] - self.starts[place]:self.starts[k + 1] - self.starts[place]]
            place = last


def write_tokens(
    docs: DataFrame, folder: str, tokenizer_path: str, vocabulary: int, end_id: int | None = 1,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Writes the files and returns their manifest: shard, path, n_docs, n_tokens, base (ids of all files before)."""
    bits = bits_for(vocabulary)
    wide = bits > 16
    bounds = range_bounds(docs.select(*id_bytes(F.col(doc_id), F.col(text))), shuffle_partitions(docs.sparkSession))
    shards = len(bounds) + 1
    rows = encoded(docs, doc_id, text, tokenizer_path, end_id, wide, bounds)
    dealt = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    kind = np.dtype("<u4" if wide else "<u2")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        shard = first.column("shard")[0].as_py()
        path = f"{folder}/tokens-{shard:06d}.bin"
        with whole_file(path) as out:
            writer = _Writer(out, bits)
            while first is not None:
                for one, ids in zip(first.column("doc_id").to_pylist(), first.column("ids")):
                    writer.add(one, np.frombuffer(ids.as_buffer(), kind))
                first = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "path": [path],
            "n_docs": [len(writer.doc_ids)], "n_tokens": [int(writer.starts[-1])],
        })

    manifest = staged(dealt.mapInArrow(write, "shard int, path string, n_docs bigint, n_tokens bigint"), "token-files")
    before = F.sum("n_tokens").over(W.orderBy("shard")) - F.col("n_tokens")
    return manifest.withColumn("base", before)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row for each document of the files: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                file = TokenFile(path)
                crc = [zlib.crc32(ids.astype("<u4", copy=False)) for _, ids in file.documents()]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(file.doc_ids, mask=~file.has_id), "start": base + file.starts[:-1],
                    "n_tokens": np.diff(file.starts), "ids_crc32": pa.array(crc, pa.int64()),
                })

    files = max(1, manifest.agg(F.max("shard")).first()[0] or 0)
    return manifest.repartitionById(files + 1, F.col("shard")).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_digest(docs: DataFrame, tokenizer_path: str, vocabulary: int, end_id: int | None = 1) -> DataFrame:
    folder = new_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer_path, vocabulary, end_id))
