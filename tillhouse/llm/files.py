"""Binary files written and read by tasks in the shared folder, and even ranges of ids for them.

Files go through ``pyarrow.fs``, so the folder may be any that it can reach by its address. A task writes to a temporary
name of its own and renames the complete file; only files that the manifest of the finished job lists are read. A task
that runs again, after its executor was lost, writes the same bytes under the same name.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SHARD = 16 << 20
MAX_SHARD = 512 << 20


def open_input(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


@contextmanager
def whole_file(path: str) -> Iterator:
    """A stream to ``path`` that becomes visible under that name when it is complete."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    temporary = f"{inner}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(temporary, compression=None) as out:
        yield out
    system.move(temporary, inner)


def shard_size(total: float, partitions: int) -> float:
    """Bytes of a shard: two shards for each shuffle partition, within limits that suit a task."""
    return min(MAX_SHARD, max(MIN_SHARD, total / (2 * partitions)))


def range_bounds(rows: DataFrame, partitions: int) -> list[int]:
    """Smallest ids of all shards but the first, for ``rows`` (id, bytes); NULL ids go to the first.

    Ids are counted in cells of a power of two; cells heavier than a shard are counted again in finer cells. The number
    of cells that come to the driver follows the number of shards, not of rows. The result depends on the rows alone.
    """
    known = rows.filter("id IS NOT NULL")
    lo, hi, total = known.agg(F.min("id"), F.max("id"), F.sum("bytes")).first()
    if lo is None:
        return []
    target = shard_size(float(total), partitions)
    bits = max(10, math.ceil(math.log2(max(1.0, 4 * float(total) / target))))
    shift = 0
    while (hi >> shift) - (lo >> shift) >= 1 << bits:
        shift += 1
    cells: list[tuple[int, float]] = []
    while True:
        cell = F.shiftright("id", shift)
        counted = [(c, float(b)) for c, b in known.groupBy(cell.alias("cell")).agg(F.sum("bytes")).collect()]
        heavy = [c for c, b in counted if b > target and shift > 0]
        cells += [(c << shift, b) for c, b in counted if c not in set(heavy)]
        if not heavy:
            break
        known, shift = known.filter(cell.isin(heavy)), max(0, shift - 12)
    bounds, filled = [], 0.0
    for start, size in sorted(cells):
        if filled and filled + size > target:
            bounds.append(start)
            filled = 0.0
        filled += size
    return bounds


def shard_numbers(edges: np.ndarray, ids: pa.Array) -> pa.Array:
    """The shards of ids; NULL ids go to the first."""
    found = np.searchsorted(edges, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), side="right")
    return pa.array(np.where(pc.is_null(ids).to_numpy(zero_copy_only=False), 0, found), pa.int32())


def shard_of(bounds: list[int]):
    """A column function: the shard of an id."""
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        out = np.zeros(len(ids), dtype=np.int32)
        out[known] = np.searchsorted(edges, ids[known].astype("int64"), side="right")
        return pd.Series(out)

    return shard


def id_bytes(doc_id: Column, data: Column) -> list[Column]:
    """The columns ``range_bounds`` asks for."""
    return [doc_id.cast("bigint").alias("id"), (F.coalesce(F.octet_length(data), F.lit(0)) + 1).cast("bigint").alias("bytes")]
