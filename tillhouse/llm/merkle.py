"""Merkle manifest of a data set: a digest for every row, a tree over each part of the rows, a tree over the parts.

Nodes have up to ``FANOUT`` children. A tree is cut into aligned blocks of ``LEVELS`` levels; the roots of blocks are the
leaves of a smaller tree, which is cut likewise, until one block is left. A block is one row whose digests lie in a van
Emde Boas layout: a tree is split at half its height, and the top part and then every bottom part are stored one after
the other, each split again, so nodes near each other in the tree lie near each other in the array whatever the size of a
cache line. ``address`` computes the place of a node from its level and number alone; building a block and looking up
siblings both go through it.

1. Digests of rows are made where they are read. Only digests are sorted, by part, id and digest, in ranges; a row's
   number in its part is its number in the range and the count of rows of its part in earlier ranges.
2. Blocks are built in groups of bounded size, level by level of blocks.
3. Paths go down again: a block gets the siblings of its root's ancestors and hands its leaves' paths to the blocks below.
   The lowest blocks make the proofs of their rows and fold (changed) digests up to the root.

Defined results: rows with equal ids in a part are ordered by their digests; NULL ids and NULL parts come first; NULL
values count as ``-``; a part of one row is that row's digest; repeated rows are leaves each; rows with a NULL id are never
tampered with; an empty table gives an empty result; columns other than the five are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillhouse.llm.common import shuffle_partitions
from tillhouse.session import staged

FANOUT = 8
LEVELS = 5  # of a block: 4096 leaves
LEAVES = FANOUT ** (LEVELS - 1)
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3


def nodes(levels: int) -> int:
    """Nodes of a full tree."""
    return (FANOUT ** levels - 1) // (FANOUT - 1)


def address(level: int, number: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Places, in van Emde Boas layout, of the nodes ``number`` of a level (0: the root) of a tree with ``levels`` levels."""
    number = np.asarray(number, np.int64)
    place = np.zeros_like(number)
    while levels > 1:
        top = levels // 2
        if level < top:
            levels = top
            continue
        below = FANOUT ** (level - top)
        place += nodes(top) + number // below * nodes(levels - top)
        number, level, levels = number % below, level - top, levels - top
    return place


def digest(parts: list[bytes]) -> bytes:
    """H of raw digests, which are hashed as their hexadecimal text."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def leaf_digest(values: list) -> bytes:
    """H of a row's values."""
    h = hashlib.sha256()
    for v in values:
        if v is None:
            h.update(b"-")
        else:
            data = v if isinstance(v, bytes) else str(v).encode()
            h.update(b"%d:" % len(data))
            h.update(data)
    return h.digest()


def tampered_id(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % TAMPER_EVERY == 0


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        own, changed = [], []
        for *values, text in zip(*columns):
            own.append(leaf_digest([*values, text]))
            bad = tampered_id(values[0]) and text is not None
            changed.append(leaf_digest([*values, text.lower()]) if bad else own[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(own, pa.binary()), pa.array(changed, pa.binary())],
            names=["doc_id", "part", "leaf", "folded"])


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, part (the language), leaf and the digest to fold (that of the row after tampering) of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "source", "lang", F.col("n_chars").cast("bigint"),
                       F.col("text").cast("binary"))  # bytes.lower() changes A-Z only
    return rows.mapInArrow(_leaves, "doc_id bigint, part string, leaf binary, folded binary")


def numbered(rows: DataFrame, part: str, order: list[str]) -> DataFrame:
    """``rows`` with pos, their number in their part by ``order``, and n, the number of rows in their part.

    The sort is by ranges of part, order and, so that equal rows can be split too, the place in the written input.
    """
    tied = staged(rows.withColumn("place", F.monotonically_increasing_id()), "merkle-rows")
    keys = [part, *order, "place"]
    ranged = tied.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    sorted_rows = staged(ranged.drop("place").withColumn("place", F.monotonically_increasing_id()).withColumn(
        "range", F.spark_partition_id()), "merkle-sorted")
    counts = sorted_rows.groupBy(part, "range").agg(F.count(F.lit(1)).alias("c"), F.min("place").alias("first"))
    own = W.partitionBy(part)
    earlier = F.coalesce(F.sum("c").over(own.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col(part).alias("p"), F.col("range").alias("r"), (earlier - F.col("first")).alias("shift"),
                            F.sum("c").over(own).alias("n"))
    met = sorted_rows.join(offsets, F.col(part).eqNullSafe(F.col("p")) & (F.col("range") == F.col("r")))
    return met.withColumn("pos", F.col("place") + F.col("shift")).drop("place", "range", "p", "r", "shift")


_BLOCK = "tree string, number bigint, n bigint, tree_of binary, root binary, doc_ids binary, known binary, folded binary"
_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


def build(level: list[bytes], whole: bool) -> tuple[np.ndarray, bytes]:
    """The layout of a block with the given leaves, and its root.

    A block that is ``whole`` (its tree has no other) grows only until one node remains; another one to its full height.
    """
    store = np.zeros((nodes(LEVELS), DIGEST), np.uint8)
    depth = LEVELS - 1
    while True:
        store[address(depth, np.arange(len(level)))] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        if depth == 0 or (whole and len(level) == 1):
            return store, level[0]
        level = [digest(level[i:i + FANOUT]) for i in range(0, len(level), FANOUT)]
        depth -= 1


def _build_group(table: pa.Table) -> pa.Table:
    """A block of the rows (tree, number, pos, n, leaf, and doc_id and folded of lowest rows)."""
    table = table.sort_by("pos")
    n = table.column("n")[0].as_py()
    store, root = build(table.column("leaf").to_pylist(), n <= LEAVES)
    ids = table.column("doc_id")
    fixed = [table.column("tree")[0].as_py(), table.column("number")[0].as_py(), n, pa.compress(store.tobytes(), "zstd", asbytes=True), root,
             ids.fill_null(0).to_numpy().astype("<i8").tobytes(), ids.is_valid().to_numpy().astype(np.uint8).tobytes(),
             b"".join(table.column("folded").to_pylist())]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
    return pa.table({name: pa.array([v], k) for name, v, k in zip(_NAMES, fixed, kinds)})


def _blocks(rows: DataFrame) -> DataFrame:
    """Blocks of rows (tree, pos, n, leaf, doc_id, folded); each is a group of ``LEAVES`` rows at most."""
    grouped = rows.withColumn("number", F.floor(F.col("pos") / LEAVES).cast("bigint"))
    return staged(grouped.groupBy("tree", "number").applyInArrow(_build_group, _BLOCK), "merkle-blocks")


def forest(rows: DataFrame) -> list[DataFrame]:
    """Blocks of all trees, lowest layer first; the last layer has one block for each tree that reaches it.

    A tree that ends in a lower layer has its only block there: ``n`` is at most ``LEAVES``.
    """
    layers = [_blocks(rows)]
    while True:
        more = layers[-1].filter(F.col("n") > LEAVES)
        if more.isEmpty():
            return layers
        layers.append(_blocks(more.select(
            "tree", F.col("number").alias("pos"), F.ceil(F.col("n") / LEAVES).cast("bigint").alias("n"), F.col("root").alias("leaf"),
            F.lit(None).cast("bigint").alias("doc_id"), F.lit(b"").alias("folded"))))


def subroots(layers: list[DataFrame]) -> DataFrame:
    """tree and root."""
    out = None
    for layer in layers:
        tops = layer.filter(F.col("n") <= LEAVES).select("tree", "root")
        out = tops if out is None else out.union(tops)
    return out


def siblings(store: np.ndarray, number: int, size: int, whole: bool) -> tuple[list[tuple[bytes, bytes]], int]:
    """Digests to the left and right of a leaf and of its ancestors in a block of ``size`` leaves, from the leaf up."""
    out, depth = [], LEVELS - 1
    while depth > 0 and not (whole and size == 1):
        run = number - number % FANOUT
        places = address(depth, np.arange(run, min(run + FANOUT, size)))
        found = store[places].tobytes()
        at = (number - run) * DIGEST
        out.append((found[:at], found[at + DIGEST:]))
        number, size, depth = number // FANOUT, -(-size // FANOUT), depth - 1
    return out, depth


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and the siblings on its path make."""
    for left, right in path:
        leaf = digest([left, leaf, right])
    return leaf


def _steps(path: list[dict]) -> list[tuple[bytes, bytes]]:
    return [(s["l"], s["r"]) for s in path]


_PATH = "array<struct<l: binary, r: binary>>"
_ARROW_PATH = pa.list_(pa.struct([("l", pa.binary()), ("r", pa.binary())]))


def _store(row: dict) -> np.ndarray:
    size = nodes(LEVELS) * DIGEST
    return np.frombuffer(pa.decompress(row["tree_of"], decompressed_size=size, codec="zstd", asbytes=True), np.uint8).reshape(-1, DIGEST)


def _leaf_count(row: dict) -> int:
    return min(LEAVES, row["n"] - row["number"] * LEAVES)


def _hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of all leaves of blocks, each with the path of its block behind its own."""
    for batch in batches:
        for row in batch.to_pylist():
            store, size, whole = _store(row), _leaf_count(row), row["n"] <= LEAVES
            paths = [[{"l": a, "r": b} for a, b in siblings(store, i, size, whole)[0]] + row["path"] for i in range(size)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * size), pa.array(range(row["number"] * LEAVES, row["number"] * LEAVES + size), pa.int64()),
                 pa.array(paths, _ARROW_PATH), pa.array([row["subroot"]] * size, pa.binary()), pa.array([row["top"]] * size, pa.binary())],
                names=["tree", "number", "path", "subroot", "top"])


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proofs of all rows of the lowest blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            store, size, whole = _store(row), _leaf_count(row), row["n"] <= LEAVES
            above, top = _steps(row["path"]), row["top"]
            own = store[address(LEVELS - 1, np.arange(size))]
            out = []
            for i in range(size):
                path = siblings(store, i, size, whole)[0] + above
                root = fold(row["folded"][i * DIGEST:(i + 1) * DIGEST], path)
                out.append((own[i].tobytes().hex(), digest([x for pair in path for x in pair]).hex(), root.hex(), root == top))
            leaf, proof, folded, good = zip(*out)
            ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.frombuffer(row["known"], np.uint8) == 0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(leaf), pa.array([row["subroot"].hex()] * size), pa.array([top.hex()] * size), pa.array(proof),
                 pa.array(folded), pa.array(good)],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def _down(layers: list[DataFrame], paths: DataFrame) -> DataFrame:
    """``paths`` (tree, path, subroot, top) of whole trees, brought down to the lowest blocks: these, with their path.

    Paths of a block are joined by tree and number, so a large tree is dealt to as many keys as it has blocks.
    """
    handed = None
    for depth in range(len(layers) - 1, -1, -1):
        layer = layers[depth]
        ends = layer.filter(F.col("n") <= LEAVES).join(paths, "tree")
        blocks = ends if handed is None else ends.unionByName(
            layer.filter(F.col("n") > LEAVES).join(handed, ["tree", "number"]))
        if depth:
            handed = staged(blocks.mapInArrow(_hand_down, f"tree string, number bigint, path {_PATH}, subroot binary, top binary"), "merkle-paths")
    return blocks


def _tree_name(part: Column) -> Column:
    """A name that sorts like the part, NULL first, and is never NULL."""
    return F.when(part.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), part))


def manifest(docs: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Stored blocks: of the trees over the parts' rows, and of the tree over the parts."""
    rows = numbered(leaves(docs).withColumn("tree", _tree_name(F.col("part"))), "tree", ["doc_id", "leaf"])
    lower = forest(rows.select("tree", "pos", "n", "leaf", "doc_id", "folded"))
    parts = subroots(lower).select(F.lit("all").alias("top"), F.col("tree").alias("part"), F.col("root").alias("leaf"))
    ordered = numbered(parts, "top", ["part"])
    kept = staged(ordered, "merkle-parts")
    upper = forest(kept.select(F.col("top").alias("tree"), "pos", "n", "leaf", F.lit(None).cast("bigint").alias("doc_id"), F.lit(b"").alias("folded")))
    return lower, [kept, *upper]


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row."""
    lower, (parts, *upper) = manifest(docs)
    top = upper[-1].select("tree", F.array().cast(_PATH).alias("path"), F.col("root").alias("subroot"), F.col("root").alias("top"))
    over_parts = _down(upper, top).mapInArrow(_hand_down, f"tree string, number bigint, path {_PATH}, subroot binary, top binary")
    paths = over_parts.join(parts.select(F.col("pos").alias("number"), F.col("part"), F.col("leaf")), "number").select(
        F.col("part").alias("tree"), "path", F.col("leaf").alias("subroot"), "top")
    return _down(lower, staged(paths, "merkle-paths")).mapInArrow(
        _prove, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
