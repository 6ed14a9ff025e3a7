"""Numbers of many rows packed into one compressed block, for shuffles whose rows would be few bytes each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to ``limit`` bytes, where a distinct word costs something once for each."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block, bytes of equal weight side by side."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
        packed = pa.compress(planes, codec="zstd", asbytes=True)
        head = np.array([len(packed), len(planes)], "<u8").tobytes() + a.dtype.str.encode().ljust(4)
        out += [head, packed]
    return b"".join(out)


def unsqueeze(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        packed, size = (int(x) for x in np.frombuffer(data, "<u8", 2, at))
        kind = np.dtype(data[at + 16:at + 20].decode().strip())
        planes = pa.decompress(data[at + 20:at + 20 + packed], decompressed_size=size, codec="zstd", asbytes=True)
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel())
        at += 20 + packed
    return out
