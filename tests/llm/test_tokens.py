"""Token files and byte-level BPE against the libraries, text by text."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tillhouse.llm import bpe, token_files
from tillhouse.llm.queries import QUERIES
from tillhouse.session import new_folder

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = ["a", "É", "é", "H̱", "1", "12", ".", " ", "  ", "\n", "\t", "\xa0", " ", "'s", "'S", "\x1c", "\x85", "中", "<|endoftext|>",
          "<|EndOfText|>", "İ", "ΑΣ", ".,", "!.", "foo", "ſ", "שׁ", "ǅ", "\r\n"]


def _texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(PIECES, k=draw.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def coder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 20), st.lists(st.integers(0, 2**20 - 1), max_size=70))
def test_packing(bits, values):
    ids = np.array([v % (1 << bits) for v in values], np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == (len(ids) * bits + 7) // 8
    assert token_files.unpack(data, len(ids), bits).tolist() == ids.tolist()


def test_bits():
    assert [token_files.bits_for(v) for v in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_word_table(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 50)  # so that the table starts afresh on the way
    table, texts = token_files.WordTable(WORDS, 1), _texts(6000, 2)
    for at in range(0, len(texts), 1000):
        ids, starts = table.encode(pa.array(texts[at:at + 1000]))
        for k, text in enumerate(texts[at:at + 1000]):
            assert ids[starts[k]:starts[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1]


def _same(table, tokenizer, texts):
    ids, starts = table.encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[starts[k]:starts[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1], text


def test_words_are_met_once(tokenizer, monkeypatch):
    table, met = token_files.WordTable(WORDS, 1), []
    learn = table._learn
    monkeypatch.setattr(table, "_learn", lambda new: (met.extend(map(str, new)), learn(new))[1])
    _same(table, tokenizer, ["École foo### foo!! école, bar", "ÉCOLE. foo?) Bar%%% bar*** x|.", "foo<|endoftext|>!", "it's. a'! É<."])
    assert sorted(met) == sorted([
        "", "###", "!!", ",", ".", "?)", "%%%", "***", "école", "foo", "bar", "x|.", "foo<|endoftext|>!", "it's", "a'!", "É<."])


def test_plain_words_meet_the_model_alone():
    table = token_files.WordTable(WORDS, 1)
    expected = [i.tolist() for i in table.encode(pa.array(["", "1 # plaîn wörds"]))]
    table._clear()
    table.encode(pa.array(["", "1 #"]))
    table.tokenizer = None
    assert [i.tolist() for i in table.encode(pa.array(["", "1 # plaîn wörds"]))] == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_latin_words(tokenizer, seed):
    draw = random.Random(seed)
    pool = [chr(c) for c in (*range(1, 0x180), *range(0x300, 0x310))] + [*token_files.STOPS, "a", "B", "é"] * 4 + ["'s", "<|endoftext|>"]
    table = token_files.WordTable(WORDS, 1)
    _same(table, tokenizer, ["".join(draw.choices(pool, k=draw.randint(0, 20))) for _ in range(5000)])


def test_other_tokenizers(folder):
    import os

    from tokenizers import Regex, Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

    splits, adds = Tokenizer.from_file(WORDS), Tokenizer.from_file(WORDS)
    splits.pre_tokenizer = Sequence([Split(Regex("[a-m]+|[^a-m\\s]+"), "removed", invert=True), ByteLevel(add_prefix_space=False, use_regex=False)])
    adds.add_tokens(["foo"])
    os.makedirs(path := folder())
    for k, other in enumerate((splits, adds)):
        other.save(f"{path}/{k}.json")
        _same(token_files.WordTable(f"{path}/{k}.json", 1), other, ["xfoo foo hello world", "one éa ñ"])


def test_whole_byte_ids(monkeypatch):
    def fail(*_, **__):
        raise AssertionError("ids of whole bytes taken to bits")

    monkeypatch.setattr(np, "packbits", fail)
    monkeypatch.setattr(np, "unpackbits", fail)
    for bits, data in ((8, b"\x01\x02\xff"), (16, b"\0\x01\0\x02\0\xff"), (32, b"\0\0\0\x01\0\0\0\x02\0\0\0\xff")):
        assert token_files.pack(np.array([1, 2, 255], np.uint32), bits) == data
        assert token_files.unpack(data, 3, bits).tolist() == [1, 2, 255]


def test_ids_are_joined_by_run(monkeypatch):
    import io

    joins, join = [], np.concatenate
    monkeypatch.setattr(np, "concatenate", lambda *a, **k: (joins.append(1), join(*a, **k))[1])
    for bits in (13, 16):
        out, ids = io.BytesIO(), np.arange(300_000, dtype=np.uint32) % 8000
        writer = token_files._Writer(out, bits)
        for at in range(0, len(ids), 100):
            writer.add(at, ids[at:at + 100])
        writer.close()
        assert len(joins) <= 4
        joins.clear()
        assert token_files.unpack(out.getvalue()[8:8 + len(ids) * bits // 8], len(ids), bits).tolist() == ids.tolist()


def test_files(spark, tokenizer):
    texts = _texts(300, 5) + [None, "", "word " * 30_000]
    rows = [(k * 3 - 50, t, "x") for k, t in enumerate(texts)] + [(None, "none", "x"), (4, "again", "x"), (4, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string").repartition(5)
    manifest = token_files.write_tokens(docs, new_folder(spark, "tokens"), WORDS, 49408)
    expected, start = [], 0
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in token_files.read_tokens(manifest).collect()), key=lambda r: r[1])
    assert got[0][0] is None
    assert [r[1:3] for r in got if r[0] != 4] == [r[1:3] for r in expected if r[0] != 4]
    assert sorted((r[0] or 0, r[2], r[3]) for r in got) == sorted((r[0] or 0, r[2], r[3]) for r in expected)
    path = manifest.filter("shard = 0").first().path
    file = token_files.TokenFile(path)
    every = file.ids(0, int(file.starts[-1]))
    for first, last in ((0, 1), (4095, 4097), (5000, 20_000), (7, 7)):
        assert file.ids(first, last).tolist() == every[first:last].tolist()
    assert file.bits == 16 and file.document(0).tolist() == every[:file.starts[1]].tolist()


def test_even_ranges(spark):
    from tillhouse.llm.files import range_bounds

    rows = spark.range(100_000).selectExpr("id", "2000L AS bytes").union(spark.createDataFrame([(2**62, 5), (-(2**62), 5)], "id long, bytes long"))
    bounds = range_bounds(rows, 8)
    assert bounds == sorted(set(bounds)) and 8 < len(bounds) < 40
    inside = [b for b in bounds if 0 < b < 100_000]
    assert max(np.diff([0, *inside, 100_000])) * 2000 < 2.5 * (16 << 20)


def test_pre_tokens(coder):
    import regex

    texts = _texts(8000, 3)
    words, codes, counts = bpe.pre_tokens(pa.array([*texts, None]), regex.compile(public_tokenizers.PATTERN).findall)
    at = 0
    for text, n in zip(texts, counts):
        pieces = [words[c] for c in codes[at:at + n]]
        at += n
        assert "".join(pieces) == text
        assert [i for p in pieces for i in coder.encode_ordinary(p)] == coder.encode_ordinary(text)
    assert counts[-1] == 0


def test_bpe_round_trip(spark, coder, folder):
    rows = [(k, t, [k]) for k, t in enumerate(_texts(400, 7))] + [(None, "none", None), (3, None, None), (3, "", None), (9, "b" * 5000, None)] * 2
    path = folder()
    spark.createDataFrame(rows, "doc_id bigint, text string, ids array<int>").write.parquet(path)
    encoded = bpe.encode(spark.read.parquet(path), RANKS, public_tokenizers.PATTERN, chunk_bytes=1000)
    got = sorted((r.doc_id or -1, r.ids, bytes(r.decoded)) for r in bpe.decode(encoded, RANKS).collect())
    assert got == sorted((i or -1, coder.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)


def test_bpe_query(spark, coder):
    got = {r.doc_id: r for r in QUERIES["op2_byte_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = coder.encode_ordinary(d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_files.token_digest(none, WORDS, 49408).count() == 0
    assert bpe.decode(bpe.encode(none, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0
