"""Line deduplication, clusters and Merkle manifests against brute force and SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tillhouse.llm import clusters, lines, merkle
from tillhouse.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "A line of more than forty characters that MANY share"


@pytest.mark.parametrize("name", ["op11_lines", "op12_clusters", "op13_merkle"])
def test_against_sql(spark, name):
    assert compare(spark, connect(SF), SF, QUERIES[name], SQL[name]) is None


def _kept_lines(rows, min_chars=40, min_docs=5):
    """doc_id, lines, dropped lines and kept text of (doc_id, text) rows."""
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip("\t\n\v\f\r "))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        left = [x for x in all_lines if i is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(all_lines), len(all_lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.integers(0, 2)), max_size=80), st.integers(2, 5),
       st.lists(st.integers(1, 80), max_size=6), st.integers(1, 20))
def test_stream_of_ranges(rows, min_docs, cuts, size):
    """Rows cut into ranges and batches at any place lose what the whole would."""
    rows = sorted(rows, key=lambda r: (r[0], -r[1], r[2]))
    holders = defaultdict(set)
    for h, d, _ in rows:
        holders[h].add(d)
    want = {r for r in rows if len(holders[r[0]]) >= min_docs and r[1] != max(holders[r[0]])}
    edges = sorted({0, len(rows), *(c for c in cuts if c < len(rows))})
    lost, waiting, summaries = [], [], defaultdict(set)
    for a, b in zip(edges, edges[1:]):
        stream, pieces = lines.LineStream(min_docs), []
        for at in range(a, b, size):
            part = np.array(rows[at:min(at + size, b)], np.int64)
            cols = {"h1": part[:, 0], "h2": part[:, 0], "doc_id": part[:, 1], "line": part[:, 2]}
            pieces += stream.feed(cols)
        pieces += stream.end()
        for kind, found, docs in pieces:
            if kind == lines.SUMMARY:
                assert len(docs) <= min_docs
                summaries[int(found["h1"][0])].update(docs)
            else:
                (lost if kind == lines.DROPPED else waiting).extend(zip(*(found[k].tolist() for k in ("h1", "doc_id", "line"))))
        assert sum(kind == lines.SUMMARY for kind, _, _ in pieces) <= 2
    lost += [r for r in waiting if len(summaries[r[0]]) >= min_docs and r[1] != max(summaries[r[0]])]
    assert set(lost) == want


def test_lines_of_hot_and_odd_texts(spark):
    draw = random.Random(5)
    shared = [f"{LONG} {i}" for i in range(6)]
    rows = [(i, "\n".join(draw.choice([LONG, LONG.upper(), f"  {LONG}\r", "short", "", *shared]) for _ in range(draw.randint(1, 9))))
            for i in range(400)]
    rows += [(7, LONG), (7, LONG), (7, LONG + "\n" + LONG), (None, LONG), (None, None), (500, None), (501, ""), (502, "\n\n"),
             (-3, "é" * 40), (-4, "É" * 40), (503, f"x {LONG}"), (504, ("y" * 200 + "\n") * 50_000)]
    rows += [(600 + i, "é" * 40) for i in range(4)] + [(700 + i, "z" * 39) for i in range(9)] + [(800, LONG)] * 500
    wide = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], "doc_id bigint, text string, kept_sha256 string, line int, h1 int")
    got = sorted(map(tuple, lines.kept_digest(wide.repartition(7)).collect()), key=str)
    assert got == _kept_lines(rows)
    cut = lines.deduplicated_rows(wide)
    assert cut.columns == wide.columns
    texts = sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in cut.collect()), key=str)
    assert texts == sorted(((r[0], r[3]) for r in got), key=str)
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert lines.kept_digest(none).count() == 0 and lines.deduplicated_rows(none).count() == 0


def test_bitmaps_name_the_lines(spark):
    rows = [(i, f"own {i}\n{LONG}\nend") for i in range(6)]
    maps = lines.keep_bitmaps(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: lines.unpack(r.keep, r.n_lines).tolist() for r in maps} == {i: [True, False, True] for i in range(5)}


def _cluster(rows, k, rounds, scale=1024, seed=3):
    """Brute force over Python integers: rows of (vec_id, integers)."""
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [list(x) for _, x in order[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in rows:
            groups[near(x)[1]].append(x)
        for j, g in groups.items():
            centroids[j] = [sum(col) // len(g) for col in zip(*g)]
    return [(i, *reversed(near(x))) for i, x in rows], centroids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-50, 50), min_size=3, max_size=3), min_size=1, max_size=40), st.integers(1, 5))
def test_tables_give_distances_and_sums(x, k):
    x = np.array(x)
    block = clusters.Block({n: v[0] for n, v in clusters.pack(np.arange(len(x)), np.ones(len(x), bool), x).items()})
    centroids = x[:k] + 1
    nearest, distance = block.assign(centroids)
    all_distances = ((x[:, None] - centroids[None]) ** 2).sum(2)
    assert nearest.tolist() == all_distances.argmin(1).tolist() and distance.tolist() == all_distances.min(1).tolist()
    assert (block.sums(nearest, k) == np.stack([x[nearest == j].sum(0) for j in range(len(centroids))] + [np.zeros(3, int)] * (k - len(centroids)))).all()


def test_clusters_of_odd_vectors(spark):
    draw = random.Random(2)
    good = [(i % 90, [draw.uniform(-2, 2) for _ in range(4)]) for i in range(120)]
    good += [(None, [0.5, 0.5, 0.5, 0.5])] * 3 + [(200, [0.0] * 4)] * 300 + [(201, [1e5, -1e5, 0.0, 131072.0])]
    bad = [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0] * 5), (304, [1.0, None, 1.0, 1.0]), (305, [float("nan")] * 4),
           (306, [float("inf"), 0.0, 0.0, 0.0]), (307, [3e38, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in good + bad], "vec_id bigint, embedding array<double>, cluster int, distance int")
    whole = [(i, [int(np.floor(1024 * c)) for c in x]) for i, x in good]
    for k, rounds in ((3, 4), (8, 10)):
        assigned, centroids = clusters.cluster(frame.repartition(5), clusters=k, rounds=rounds, dimensions=4)
        want, centres = _cluster(whole, k, rounds)
        assert sorted(map(tuple, assigned.collect()), key=str) == sorted(want, key=str) and centroids.tolist() == centres
    rows = clusters.with_inertia(assigned, centroids).collect()
    assert {r.inertia for r in rows} == {sum(r.distance for r in rows)} and len(rows) == len(good)
    few = spark.createDataFrame(good[:2] + bad, "vec_id bigint, embedding array<float>")
    assert len(clusters.cluster(few, dimensions=4)[1]) == 2
    none = clusters.cluster(few.limit(0), dimensions=4)
    assert clusters.with_inertia(*none).count() == 0


@pytest.mark.parametrize("levels", range(1, 7))
def test_addresses_fill_the_layout(levels):
    places = np.concatenate([merkle.address(d, np.arange(merkle.FANOUT ** d), levels) for d in range(levels)])
    assert sorted(places.tolist()) == list(range(merkle.nodes(levels))) and places[0] == 0


def test_layout_is_split_at_half_height():
    # Four levels: the top two levels (9 nodes) come first, then 64 subtrees of two levels with 9 nodes each.
    assert merkle.address(1, [0, 7], 4).tolist() == [1, 8]
    assert merkle.address(2, [0, 1, 63], 4).tolist() == [9, 18, 9 + 63 * 9]
    assert merkle.address(3, [0, 7, 8], 4).tolist() == [10, 17, 19]


def _h(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def _leaf(values):
    return _h(b"".join(b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode()) for v in values))


def _levels(xs):
    out = [xs]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def _path(levels, i):
    out = []
    for xs in levels[:-1]:
        run = i // 8 * 8
        out.append(("".join(xs[run:i]), "".join(xs[i + 1:run + 8])))
        i //= 8
    return out


def _manifest(rows):
    """Brute force over (doc_id, source, lang, n_chars, text)."""
    parts = defaultdict(list)
    for r in rows:
        parts[r[2]].append(r)
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = []
    for name in names:
        own = sorted(((r[0] is not None, r[0] or 0, _leaf(r), r) for r in parts[name]), key=lambda x: x[:3])
        trees.append((own, _levels([x[2] for x in own])))
    top = _levels([t[-1][0] for _, t in trees])
    out = []
    for k, (own, tree) in enumerate(trees):
        for i, (_, _, leaf, r) in enumerate(own):
            path = _path(tree, i) + _path(top, k)
            folded = leaf
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                folded = _leaf([*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])])
            for a, b in path:
                folded = _h(a + folded + b)
            out.append((r[0], leaf, tree[-1][0], top[-1][0], _h("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def test_manifest_of_odd_rows(spark):
    draw = random.Random(1)
    rows = [(i, draw.choice([None, "", "s"]), draw.choice([None, "", "en", "é", "z"]), draw.choice([None, 5]),
             draw.choice([None, "", "Some Text É", "low"])) for i in range(300)]
    rows += [(5, "s", "en", 1, "A"), (5, "s", "en", 1, "B"), (None, "s", "en", 1, "A"), (None, None, None, None, None)]
    rows += [(9, "s", "hot", 3, "Same Row")] * 700 + [(-7, "s", "one", 1, "X" * 100_000)]
    columns = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf int, pos int, tree string"
    frame = spark.createDataFrame([(*r, 1, 2, "t") for r in rows], columns)
    assert sorted(map(tuple, merkle.proofs(frame.repartition(6)).collect()), key=str) == _manifest(rows)
    assert merkle.proofs(frame.limit(0)).count() == 0
    single = frame.filter("lang = 'one'")
    assert [tuple(r) for r in merkle.proofs(single).collect()] == _manifest(rows[-1:])


@pytest.mark.parametrize("parts, each", [(1, 9000), (70, 1), (3, 4096), (2, 4097)])
def test_manifest_of_many_blocks(spark, parts, each):
    """Trees of one and of several blocks, in one and in more layers, at the edges of a block."""
    rows = [(i, None, f"p{i % parts:03d}", None, f"T{i}") for i in range(parts * each)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert sorted(map(tuple, merkle.proofs(frame).collect()), key=str) == _manifest(rows)


def test_manifest_of_many_parts(spark):
    """More parts than a block has leaves: the tree over the parts has layers too."""
    rows = [(i, None, f"p{i:05d}", None, "T") for i in range(5000)]
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("source"),
                                     F.format_string("p%05d", "id").alias("lang"), F.lit(None).cast("bigint").alias("n_chars"),
                                     F.lit("T").alias("text"))
    assert sorted(map(tuple, merkle.proofs(frame).collect()), key=str) == _manifest(rows)
