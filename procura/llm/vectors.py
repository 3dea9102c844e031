"""Vectors as packed doubles, and bounded blocks of queries against all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of the query vectors that one pass over the table takes along (also their count times 512 bytes of state).
QUERY_BYTES = 4 << 20
#: Doubles hold every integer below this exactly.
EXACT = float(1 << 53)


def row_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each row's vector as doubles; None if it is null or has a null or non-finite component."""
    out: list[np.ndarray | None] = []
    for v in column:
        x = v.values.cast(pa.float64()).to_numpy(zero_copy_only=False) if v.is_valid else None
        out.append(x if x is not None and np.isfinite(x).all() else None)
    return out


def packed(prepare: Callable[[np.ndarray], np.ndarray | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Map for batches whose last column is the vector: it becomes packed doubles of ``prepare(vector)``; rows without one go."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [None if x is None else prepare(x) for x in row_vectors(batch.column(batch.num_columns - 1))]
            keep = [i for i, x in enumerate(rows) if x is not None]
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[:-1], pa.array([rows[i].astype("<f8").tobytes() for i in keep], pa.binary())], names=batch.schema.names)

    return apply


def by_length(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of vector among packed vectors."""
    sizes = np.array([len(r) // 8 for r in raw], np.int64)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, np.frombuffer(b"".join(raw[i] for i in at), "<f8").reshape(len(at), int(dim))


def query_blocks(queries: DataFrame, limit: int = QUERY_BYTES) -> Iterator[list]:
    """The rows of ``queries`` (last column: packed vector), in lists of a bounded size.

    One block at a time is on the driver, with one partition of the rows in
    flight; vectors count as 512 bytes at least.
    """
    block, size = [], 0
    for row in queries.toLocalIterator():
        block.append(row)
        size += max(512, len(row[-1]))
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block
