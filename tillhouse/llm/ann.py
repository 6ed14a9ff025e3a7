"""Approximate nearest neighbours by inner product, with a robust-pruned directed graph in each shard.

Equal vectors are one node, so a vector that many rows hold doesn't fill a graph; of its rows only the ``k`` + 1 with the
smallest ids can be among anybody's ``k`` nearest, ties going to the smaller id. Nodes are dealt evenly to shards of
bounded size, and every node is indexed.

A shard's graph grows in batches: a greedy search of the graph so far proposes neighbours for each new node; pruning
keeps the nearest and drops those that a kept one is nearer to, by a factor ``ALPHA`` (so that some long edges stay);
kept neighbours get an edge back, pruned likewise. An extra dimension makes all vectors of a shard equally long, which
turns the largest inner product into the smallest distance. Distances for pruning are taken in double precision.

Queries go to every shard in blocks, where a beam search proposes candidates. These are scored again in double precision
on the original vectors, and the best of all shards are returned.

Defined results: vectors that are NULL, zero, hold NULL or non-finite components, or have another length than most, and
rows with a NULL id take no part; equal scores go to the smaller id; a row repeated under one id counts once; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillhouse.session import staged

K = 20
SHARD_ROWS = 8192
QUERY_BLOCK = 4096
DEGREE = 32  # edges by distance
AHEAD = 16  # and by inner product
BUILD_BEAM = 64
QUERY_BEAM = 128
EXPAND = 4  # nodes of a beam expanded in a step
ENTRIES = 16  # half of them the longest vectors
ALPHA = 1.2
BATCH = 512
MOST_TASKS = 20_000
GRAPH = "shard int, nodes array<struct<ids:array<bigint>,vector:array<double>>>, edges binary"


def _level(vectors: np.ndarray) -> np.ndarray:
    """Vectors with a dimension more, in which they would be equally long from a point beyond the shard's longest.

    That dimension is small for all but long vectors, so a very long one takes no precision from the others' distances.
    """
    squares = (vectors**2).sum(axis=1)
    longest = squares.max()
    return np.column_stack([vectors, -squares / (np.sqrt(longest - squares) + np.sqrt(longest))])


def _order(points: np.ndarray, seed: int = 7) -> np.ndarray:
    """Nodes as they are added: the longest first, which have few edges to them, then at random; the first are entries."""
    order = np.random.default_rng(seed).permutation(len(points))
    longest = np.argsort(points[order, -1], kind="stable")[:ENTRIES // 2]
    return np.concatenate([order[longest], np.delete(order, longest)])


def beam_search(points: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nodes found, nearest first (-1: none), and their inner products."""
    rows = np.arange(len(queries))[:, None]
    seen = np.zeros((len(queries), len(points)), bool)
    seen[:, entries] = True
    nodes = np.full((len(queries), beam), -1)
    near = np.full((len(queries), beam), -np.inf, queries.dtype)
    done = np.ones((len(queries), beam), bool)
    count = min(beam, len(entries))
    nodes[:, :count], near[:, :count], done[:, :count] = entries[:count], queries @ points[entries[:count]].T, False
    active = np.arange(len(queries))
    while len(active):
        waiting = np.where(done[active], -np.inf, near[active])
        pick = np.argpartition(-waiting, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND]
        going = np.take_along_axis(waiting, pick, 1) > -np.inf
        active, pick, going = active[going.any(axis=1)], pick[going.any(axis=1)], going[going.any(axis=1)]
        if not len(active):
            break
        at = active[:, None]
        next_nodes = np.where(going, nodes[at, pick], -1)
        done[at, pick] = True
        new = np.where(next_nodes[:, :, None] >= 0, edges[next_nodes], -1).reshape(len(active), -1)
        new = np.sort(new, axis=1)
        fresh = (new >= 0) & ~seen[at, np.maximum(new, 0)]
        fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
        width = int(fresh.sum(axis=1).max(initial=0))
        if not width:
            continue
        order = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
        new, fresh = np.take_along_axis(new, order, 1), np.take_along_axis(fresh, order, 1)
        seen[np.broadcast_to(at, new.shape)[fresh], new[fresh]] = True
        products = np.matmul(points[np.maximum(new, 0)], queries[active][:, :, None])[:, :, 0]
        products[~fresh] = -np.inf
        all_near = np.concatenate([near[active], products], axis=1)
        all_nodes = np.concatenate([nodes[active], np.where(fresh, new, -1)], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        best = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        near[active], nodes[active], done[active] = (np.take_along_axis(x, best, 1) for x in (all_near, all_nodes, all_done))
    order = np.argsort(-near, axis=1)
    return nodes[rows, order], near[rows, order]


def robust_prune(points: np.ndarray, of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """For each node at most ``DEGREE`` of its candidates (-1: none), diverse in direction."""
    ok = (candidates >= 0) & (candidates != of[:, None])
    vectors = points[np.maximum(candidates, 0)]
    squares = (vectors**2).sum(axis=2)
    distance = np.maximum(squares + (points[of] ** 2).sum(axis=1)[:, None] - 2 * np.matmul(vectors, points[of][:, :, None])[:, :, 0], 0)
    distance[~ok] = np.inf
    order = np.argsort(distance, axis=1)
    candidates, distance = np.take_along_axis(candidates, order, 1), np.take_along_axis(distance, order, 1)
    vectors, squares = np.take_along_axis(vectors, order[:, :, None], 1), np.take_along_axis(squares, order, 1)
    between = np.maximum(squares[:, :, None] + squares[:, None] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1)), 0)
    alive = np.isfinite(distance)
    left = alive & np.concatenate([np.ones((len(of), 1), bool), candidates[:, 1:] != candidates[:, :-1]], axis=1)
    kept = np.full((len(of), DEGREE), -1)
    rows = np.arange(len(of))
    for k in range(DEGREE):
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        kept[:, k] = np.where(some, candidates[rows, pick], -1)
        alive &= ALPHA**2 * between[rows, pick] > distance
        alive &= candidates != kept[:, k:k + 1]
        left &= candidates != kept[:, k:k + 1]
    # Places that are still free go to the nearest of the others.
    order = np.argsort(~left, axis=1, kind="stable")[:, :DEGREE]
    spare = np.where(np.take_along_axis(left, order, 1), np.take_along_axis(candidates, order, 1), -1)
    used = (kept >= 0).sum(axis=1)
    at = np.arange(DEGREE) - used[:, None]
    return np.where(at < 0, kept, np.take_along_axis(spare, np.clip(at, 0, spare.shape[1] - 1), 1))


def best_products(points: np.ndarray, of: np.ndarray, candidates: np.ndarray, width: int) -> np.ndarray:
    """For each node its ``width`` candidates with the greatest inner products (-1: none): where vectors differ in length,
    long ones, which distances keep out of the graph."""
    candidates = np.sort(candidates, axis=1)
    ok = (candidates >= 0) & (candidates != of[:, None])
    ok[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    products = np.matmul(points[np.maximum(candidates, 0), :-1], points[of, :-1][:, :, None])[:, :, 0]
    products[~ok] = -np.inf
    order = np.argsort(-products, axis=1, kind="stable")[:, :width]
    found = np.where(np.isfinite(np.take_along_axis(products, order, 1)), np.take_along_axis(candidates, order, 1), -1)
    return np.pad(found, ((0, 0), (0, width - found.shape[1])), constant_values=-1)


def _link_back(edges: np.ndarray, new: np.ndarray, keep) -> None:
    """Edges from the neighbours of ``new`` nodes back to them, as far as ``keep`` chooses them."""
    source = np.repeat(new, edges.shape[1])
    target = edges[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, start, count = np.unique(target, return_index=True, return_counts=True)
    for size in np.unique(np.minimum(count, 4 * DEGREE) // DEGREE):  # alike in size, so that little is padded
        some = np.flatnonzero(np.minimum(count, 4 * DEGREE) // DEGREE == size)
        width = int(count[some].max())
        at = start[some][:, None] + np.arange(width)
        incoming = np.where(np.arange(width) < count[some][:, None], source[np.minimum(at, len(source) - 1)], -1)
        for part in np.array_split(np.arange(len(some)), 1 + len(some) * (width + DEGREE) ** 2 // 8_000_000):
            own = nodes[some[part]]
            edges[own] = keep(own, np.concatenate([edges[own], incoming[part]], axis=1))


def build_graph(points: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Edges of every node (-1: none) and the nodes where searches enter."""
    n = len(points)
    order = _order(points, seed)
    nearness = np.column_stack([points, -(points**2).sum(axis=1) / 2])  # the greatest product with (x, 1) is nearest to x
    edges = np.full((n, DEGREE + AHEAD), -1)
    near, ahead = edges[:, :DEGREE], edges[:, DEGREE:]

    def by_distance(of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        return robust_prune(points, of, candidates)

    def by_product(of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        known = (candidates[:, :, None] == near[of][:, None]).any(axis=2)
        return best_products(points, of, np.where(known, -1, candidates), AHEAD)

    first = order[:DEGREE + 1]
    near[first] = by_distance(first, np.broadcast_to(first, (len(first), len(first))).copy())
    entries = order[:ENTRIES]
    at = len(first)
    while at < n:
        some = order[at:at + min(BATCH, at)]
        found, _ = beam_search(nearness, edges, entries, np.column_stack([points[some], np.ones(len(some))]), BUILD_BEAM)
        longer, _ = beam_search(points, edges, entries, np.column_stack([points[some, :-1], np.zeros(len(some))]), BUILD_BEAM)
        near[some], ahead[some] = by_distance(some, found), by_product(some, np.concatenate([longer, found], axis=1))
        _link_back(near, some, by_distance)
        _link_back(ahead, some, by_product)
        at += len(some)
    return edges, entries


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _vectors(rows: pa.Array) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def index(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graphs of all shards, as a table, of ``vectors`` (vec_id, vector, distinct and usable)."""
    by_vector = W.partitionBy("vector").orderBy("vec_id")
    nodes = vectors.withColumn("place", F.row_number().over(by_vector)).filter(F.col("place") <= k + 1)
    nodes = staged(nodes.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-nodes")
    shards = max(1, math.ceil(nodes.count() / shard_rows))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        edges, _ = build_graph(_level(_vectors(table.column("vector").chunk(0))))
        rows = pa.StructArray.from_arrays([table.column("ids").chunk(0), table.column("vector").chunk(0)], names=["ids", "vector"])
        return pa.table({
            "shard": table.column("shard").slice(0, 1), "nodes": pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
            "edges": pa.array([edges.astype("<i4").tobytes()])})

    # A shard is few bytes but much work, so shards aren't left to be coalesced into few tasks.
    dealt = nodes.repartition(min(MOST_TASKS, 4 * shards), "shard")
    return staged(dealt.groupBy("shard").applyInArrow(build, GRAPH), "ann-graphs")


def search(graphs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` nearest rows for each of ``queries`` (vec_id, vector): query_id, rank, vec_id, score."""
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    shards = (graphs.agg(F.max("shard")).first()[0] or 0) + 1
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    asked = asked.groupBy("block").agg(F.collect_list(F.struct("vec_id", "vector")).alias("queries"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    copies = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    tasks = min(MOST_TASKS, 4 * shards * blocks)
    pairs = copies.repartition(tasks, "shard", "block").join(asked.repartition(tasks, "shard", "block"), ["shard", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                nodes, asked = (batch.column(c).slice(number, 1).flatten() for c in ("nodes", "queries"))
                yield _nearest(nodes, asked, batch.column("edges")[number].as_py(), k)

    found = pairs.select("nodes", "edges", "queries").mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(nodes: pa.StructArray, asked: pa.StructArray, edges: bytes, k: int) -> pa.RecordBatch:
    ids, vectors = nodes.field("ids"), _vectors(nodes.field("vector"))
    query_ids, queries = asked.field("vec_id").to_numpy(), _vectors(asked.field("vector"))
    level = _level(vectors)
    entries, points = _order(level)[:ENTRIES], level.astype(np.float32)
    graph = np.frombuffer(edges, "<i4").reshape(len(points), DEGREE + AHEAD).astype(np.int64)
    id_ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
    all_ids = ids.flatten().to_numpy()
    out: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, len(queries), BATCH):
        some = queries[at:at + BATCH]
        level = np.column_stack([some, np.zeros(len(some))]).astype(np.float32)
        found, _ = beam_search(points, graph, entries, level, QUERY_BEAM)
        found = found[:, :2 * k + 2]
        row, place = np.nonzero(found >= 0)
        node = found[row, place]
        score = (some[row] * vectors[node]).sum(axis=1)
        counts = np.diff(id_ends)[node]
        ends = np.cumsum(counts)
        vec = all_ids[np.repeat(id_ends[node] - (ends - counts), counts) + np.arange(len(np.repeat(node, counts)))]
        row, score = np.repeat(row, counts), np.repeat(score, counts)
        other = vec != query_ids[at + row]
        row, vec, score = row[other], vec[other], score[other]
        order = np.lexsort((vec, -score, row))
        row, vec, score = row[order], vec[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        for column, values in zip(out, (query_ids[at + row], vec, score)):
            column.append(values[rank < k])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0)) for c in out], names=["query_id", "vec_id", "score"])


def nearest(
    table: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The ``k`` nearest other rows of every row of ``table`` for which ``is_query`` (a condition on vec_id) holds."""
    rows = table.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    rows = staged(rows.filter(F.size("vector") == (sizes[0] if sizes else 0)).distinct(), "ann-rows")
    return search(index(rows, k, shard_rows), rows.filter(is_query), k)
