"""Clusters of vectors around centroids, in exact integers, with distances looked up in tables.

Components become integers, floor(``scale`` x). Vectors are stored in blocks, column by column: the integer values that
occur in a block in each dimension, sorted, and for each vector the place of its value. In every round a task tabulates,
for each dimension, occurring value and centroid, the squared difference; a vector's distances are sums of entries
gathered from these tables. The sums of a cluster come from the same places: how often each value occurs in it, times the
value. Blocks are written once and read in every round; a task returns the sums of the centroids, however many vectors it
has, and only these, added up, reach the driver.

Defined results: vectors that are NULL, of another length, or with a component that is NULL, not finite, or outside of
+-2^27 when scaled (whose squared distances may not fit 64 bits) take no part; starting centroids are the vectors with the
smallest hashes of their ids, ties go to the smaller integers, NULL ids come last; vectors fewer than the centroids make
fewer centroids; equal vectors and repeated rows count each; empty clusters keep their centroid; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.session import staged

CLUSTERS = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
SEED = 3
LIMIT = 1 << 27
BLOCK = 8192  # vectors

_BLOCK = "n int, ids binary, known binary, sizes binary, values binary, places binary"


def _integers(vectors: pa.Array, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that take part, and their scaled integers."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(sizes == dimensions)
    flat = vectors.take(pa.array(right)).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(len(right), dimensions)  # NULL components are NaN here
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(x * scale)
        good = (np.abs(scaled) <= LIMIT).all(axis=1)
    return right[good], scaled[good].astype(np.int64)


def pack(vec_ids: np.ndarray, known: np.ndarray, x: np.ndarray) -> dict[str, list]:
    """A block of vectors: occurring values of every dimension, and the place of each vector's value among them."""
    values, places = zip(*(np.unique(column, return_inverse=True) for column in x.T))
    sizes = np.array([len(v) for v in values], np.int32)
    kind = np.uint16  # a block has no more vectors than that
    return {"n": [len(x)], "ids": [vec_ids.astype("<i8").tobytes()], "known": [known.astype(np.uint8).tobytes()], "sizes": [sizes.tobytes()],
            "values": [np.concatenate(values).astype("<i4").tobytes()], "places": [np.stack(places).astype(kind).tobytes()]}


class Block:
    """A block of vectors as ``pack`` wrote it."""

    def __init__(self, row: dict):
        self.n = row["n"]
        self.ids, self.known = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["known"], np.uint8).astype(bool)
        sizes = np.frombuffer(row["sizes"], np.int32)
        self.values = np.split(np.frombuffer(row["values"], "<i4").astype(np.int64), np.cumsum(sizes)[:-1])
        self.places = np.frombuffer(row["places"], np.uint16).reshape(len(sizes), self.n)

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid, the first of equally near ones, and the squared distance, of every vector."""
        total = np.zeros((self.n, len(centroids)), np.int64)
        for values, places, centre in zip(self.values, self.places, centroids.T):
            table = (values[:, None] - centre[None, :]) ** 2
            total += table[places]
        nearest = total.argmin(axis=1)
        return nearest, total[np.arange(self.n), nearest]

    def sums(self, nearest: np.ndarray, clusters: int) -> np.ndarray:
        """Sum of each cluster and dimension: occurrences of every value in the cluster, times the value."""
        out = np.zeros((clusters, len(self.values)), np.int64)
        for d, (values, places) in enumerate(zip(self.values, self.places)):
            times = np.bincount(nearest * len(values) + places, minlength=clusters * len(values))
            out[:, d] = times.reshape(clusters, len(values)) @ values
        return out


def _pack_all(dimensions: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def emit():
            ids, known, x = (np.concatenate(p) for p in zip(*parts))
            for at in range(0, len(x), BLOCK):
                cut = slice(at, at + BLOCK)
                yield pa.RecordBatch.from_pydict(pack(ids[cut], known[cut], x[cut]), pa.schema(
                    [("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "known", "sizes", "values", "places"))]))

        for batch in batches:
            rows, x = _integers(batch.column(1), dimensions, scale)
            ids = batch.column(0).take(pa.array(rows))
            if len(rows):
                parts.append((ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), x))
                held += len(rows)
            if held >= BLOCK:
                yield from emit()
                parts, held = [], 0
        if parts:
            yield from emit()

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block({n: batch.column(c)[i].as_py() for c, n in enumerate(batch.schema.names)})


def _smallest(clusters: int, seed: int):
    """The vectors of a task with the smallest hashes: bounded by the number of centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []
        for b in _blocks(batches):
            named = [(not k, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if k else "", at)
                     for at, (i, k) in enumerate(zip(b.ids.tolist(), b.known.tolist()))]
            # Ties are settled by the vectors, so all of a tie's rows count: keep those up to the last hash wanted.
            last = sorted(x[:2] for x in named)[min(clusters, b.n) - 1]
            close = np.array([x[2] for x in named if x[:2] <= last])
            x = np.stack([v[p[close]] for v, p in zip(b.values, b.places)], 1)
            best = sorted(best + [(*named[at][:2], tuple(row)) for at, row in zip(close.tolist(), x.tolist())])[:clusters]
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in best]), pa.array([x[1] for x in best]), pa.array([x[2] for x in best], pa.list_(pa.int64()))],
                names=["unknown", "hash", "centre"])

    return run


def _partial_sums(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for block in _blocks(batches):
            nearest, _ = block.assign(centroids)
            count += np.bincount(nearest, minlength=k)
            total += block.sums(nearest, k)
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array(count[full]), pa.array(list(total[full]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            nearest, distance = block.assign(centroids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, mask=~block.known), pa.array(nearest, pa.int32()), pa.array(distance)],
                names=["vec_id", "cluster", "distance"])

    return run


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: a row for each cluster and dimension is added up in Spark."""
    parts = blocks.mapInArrow(_partial_sums(centroids), "cluster int, n bigint, sums array<bigint>")
    added = parts.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = centroids.copy()
    for row in added.collect():  # centroids x dimensions
        out[row.cluster, row.d] = int(row.s) // int(row.n)
    return out


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
            scale: int = SCALE, seed: int = SEED, column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and squared distance of every vector that takes part, and the final centroids."""
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col(column).cast("array<double>"))
    blocks = staged(rows.mapInArrow(_pack_all(dimensions, scale), _BLOCK), "vector-blocks")
    first = blocks.mapInArrow(_smallest(clusters, seed), "unknown boolean, hash string, centre array<bigint>")
    centroids = np.array([r.centre for r in first.orderBy("unknown", "hash", "centre").limit(clusters).collect()], np.int64)
    centroids = centroids.reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(blocks, centroids)
    return blocks.mapInArrow(_assigned(centroids), "vec_id bigint, cluster int, distance bigint"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The vectors with cluster_inertia, inertia and centroid_sha256: one row a cluster is broadcast."""
    kept = staged(assigned, "clusters")
    own = {r.cluster: r.s for r in kept.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row a cluster
    rows = [(k, own[k], sum(own.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for k, c in enumerate(centroids.tolist()) if k in own]
    figures = kept.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return kept.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
