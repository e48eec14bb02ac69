"""Sorted partitions as runs of equal key, across the borders of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal ``keys`` from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        if held:
            last = [held[-1].column(k)[-1].as_py() for k in keys]
            change[0] = any(c[0] != x for c, x in zip(columns, last))
        borders = np.flatnonzero(change)
        begin = 0
        for border in borders:
            if border > begin or held:
                yield pa.Table.from_batches([*held, batch.slice(begin, border - begin)])
                held = []
            begin = int(border)
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def fixed_binary(column: pa.ChunkedArray | pa.Array, dtype: str, width: int) -> np.ndarray:
    """Binary values of one length as rows of a matrix."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8)
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(dtype).reshape(len(values), width)


def binary_rows(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    matrix = np.ascontiguousarray(matrix)
    size = matrix.shape[1] * matrix.itemsize
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(matrix), [None, pa.py_buffer(matrix)])
    return fixed.cast(pa.binary())


def ragged(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of arrays, and the offsets of its rows."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(values.offsets)
    return np.asarray(values.values)[offsets[0] : offsets[-1]], offsets - offsets[0]
