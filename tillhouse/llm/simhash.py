"""SimHash near-duplicates, found with BK-trees.

A text's fingerprint has a bit set where more than half of the hashes of its word shingles have it set. Texts whose
fingerprints differ in at most ``radius`` bits are linked, and linked texts form a component.

Fingerprints, each distinct one once, are dealt to shards: the 64 bits are cut into ``radius`` + 3 blocks, and two
fingerprints within the radius agree in at least three of these. So for each choice of three blocks, those that agree in
all of them share a shard. A shard is searched with a BK-tree: children hang below their parent by their Hamming
distance to it, and a query follows only the edges within the radius of its own distance. A large shard is cut into
trees of bounded size, and blocks of queries go to each of these trees, so no task holds a whole hot shard. All trees of
a task are built and searched together, level by level.

A task returns for each fingerprint the least one it is connected with there, not all pairs. No link is lost.

Defined results: a NULL or empty text, and one without words, has fingerprint zero and is linked like any other; fewer
words than a shingle make one shingle; equal texts share their fingerprint; component_id ignores NULL ids and is NULL
where a component has no other; an empty table gives an empty result; other columns are ignored by ``near_duplicates``
and kept by ``one_of_each``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import fresh, giving_back, shuffle_partitions
from tillhouse.llm.components import components
from tillhouse.session import staged

SHINGLE = 3
RADIUS = 3
SEED = 42
TREE = 4096  # fingerprints of a tree, about
AT_ONCE = 200_000  # rows searched together
FRONTIER = 4_000_000  # pairs of query and node, about, that are compared at once


def shingle_hashes(text: bytes, size: int) -> list[int]:
    words = text.lower().split()  # of bytes: only A-Z change, and only ASCII white space parts words
    if len(words) <= size:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
    import xxhash

    return list(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles))


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of runs of hashes; an empty run has zero."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > counts[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed integer) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held, counts = [], [], []
            for value in batch.column("text"):
                data = value.as_buffer()
                hashes = shingle_hashes(data.to_pybytes() if data is not None else b"", shingle)
                held += hashes
                counts.append(len(hashes))
                if len(held) > 300_000:
                    found.append(majority(np.array(held, np.uint64), np.array(counts)))
                    held, counts = [], []
            found.append(majority(np.array(held, np.uint64), np.array(counts, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.concatenate(found).view(np.int64))],
                names=["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    return rows.mapInArrow(giving_back(run), "doc_id bigint, text_hash bigint, fp bigint")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def block_masks(radius: int) -> list[int]:
    """Masks of all choices of three among ``radius`` + 3 blocks of the 64 bits, as signed integers."""
    blocks, at = [], 0
    for k in range(radius + 3):
        width = (64 - at) // (radius + 3 - k)
        blocks.append(((1 << width) - 1) << at)
        at += width
    masks = (a | b | c for a, b, c in itertools.combinations(blocks, 3))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class BKForest:
    """BK-trees over numbers, one for each group; ``groups`` are 0, 1, ... in order, each with one number at least."""

    def __init__(self, groups: np.ndarray, values: np.ndarray):
        self.values = values
        self.roots = np.searchsorted(groups, np.arange(groups[-1] + 1)) if len(groups) else np.zeros(0, np.int64)
        at = self.roots[groups] if len(groups) else groups
        rest = np.flatnonzero(at != np.arange(len(values)))
        at = at[rest]
        edges, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(rest):
            edge = at * 65 + np.bitwise_count(values[rest] ^ values[at])
            order = np.argsort(edge, kind="stable")
            rest, edge = rest[order], edge[order]
            new = np.concatenate([[True], edge[1:] != edge[:-1]])
            edges.append(edge[new])
            children.append(rest[new])
            at = rest[new][np.cumsum(new) - 1][~new]
            rest = rest[~new]
        edges, children = np.concatenate(edges), np.concatenate(children)
        order = np.argsort(edges)
        self.edges, self.children = edges[order], children[order]

    def search(self, groups: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and node within the radius."""
        query, node = np.arange(len(values)), self.roots[groups]
        queries, nodes = [], []
        while len(query):
            distance = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
            near = distance <= radius
            queries.append(query[near])
            nodes.append(node[near])
            low = np.searchsorted(self.edges, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.edges, node * 65 + np.minimum(distance + radius, 64), side="right")
            counts = high - low
            ends = np.cumsum(counts)
            query = np.repeat(query, counts)
            node = self.children[np.arange(len(query)) + np.repeat(low - (ends - counts), counts)]
        return np.concatenate(queries) if queries else query, np.concatenate(nodes) if nodes else node


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a and b: each node's label is the least node it is connected with."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _links(key: np.ndarray, i: np.ndarray, j: np.ndarray, part: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and the least they are connected with, over whole (key, i, j) groups in order."""
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    group = np.cumsum(new) - 1
    distinct, place = np.unique(fp, return_inverse=True)
    value = fp.view(np.uint64)
    in_tree = part == i
    has_tree = np.zeros(group[-1] + 1, bool)
    has_tree[group[in_tree]] = True
    number = np.cumsum(has_tree) - 1
    tree = np.flatnonzero(in_tree)
    forest = BKForest(number[group[tree]], value[tree])
    asked = np.flatnonzero((part == j) & has_tree[group])
    sizes = np.bincount(group[tree], minlength=group[-1] + 1)[group[asked]]
    label = np.arange(len(distinct))
    for some in np.split(asked, np.flatnonzero(np.diff(np.cumsum(sizes) // FRONTIER)) + 1):
        query, node = forest.search(number[group[some]], value[some], radius)
        a, b = place[some[query]], place[tree[node]]
        label = _join(label, a[a != b], b[a != b])
    child = label != np.arange(len(distinct))
    return distinct[child], distinct[label[child]]


def links(fps: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """a and b: links that connect the fingerprints of ``fps`` (fp, distinct) as all links within the radius do."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(block_masks(radius))])
    keyed = fps.select("fp", F.explode(keys).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / tree).cast("int")
    members = keyed.join(shared, "key").withColumn("part", F.pmod(F.xxhash64("fp", "key"), parts).cast("int"))
    members = members.select("key", "fp", "part", F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    members = members.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "fp")
    dealt = members.repartition(shuffle_partitions(fps.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j")
    names = ("key", "i", "j", "part", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def search(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _links(*columns, radius)], names=["a", "b"])

        def joined() -> list[np.ndarray]:
            return [np.concatenate(c) for c in zip(*held)]

        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in names])
            if sum(len(h[0]) for h in held) >= AT_ONCE:
                columns = joined()
                last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
                cut = len(last) - int(last.sum())  # the last group may go on
                yield from search([c[:cut] for c in columns])
                held = [[c[cut:] for c in columns]]
        if held:
            yield from search(joined())

    return dealt.mapInArrow(giving_back(run), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_hash, fp, component (its least fingerprint), component_id."""
    marks = staged(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = marks.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    joined = components(links(distinct.select("fp"), radius)).withColumnsRenamed({"node": "fp", "root": "component"})
    by_fp = distinct.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = by_fp.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return marks.join(by_fp.select("fp", "component").join(least, "component"), "fp").select(
        "doc_id", "text_hash", "fp", "component", "component_id")


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
) -> DataFrame:
    """The rows of ``docs``, one for each component: that with the least doc_id, a NULL id being the greatest."""
    found = near_duplicates(docs, doc_id, text, shingle, radius)
    kept = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k"))
    ids, hashes = fresh(docs, "_id"), fresh(docs, "_hash")
    kept = kept.select(F.coalesce(F.col("k.doc_id").cast("string"), F.lit("")).alias(ids), F.col("k.text_hash").alias(hashes))
    keyed = docs.withColumns({
        ids: F.coalesce(F.col(doc_id).cast("bigint").cast("string"), F.lit("")), hashes: text_hash(F.col(text))})
    return keyed.join(kept, [ids, hashes], "left_semi").dropDuplicates([ids, hashes]).select(*[F.col(f"`{c}`") for c in docs.columns])


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
