"""Arrow batches of vectors as matrices, and sums of blocks of numbers on Spark."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64


def finite_vectors(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lengths, values) of the vectors without null or non-finite entries.

    ``rows`` are their places in the column, ``values`` their entries as doubles, one
    after the other. With a ``width``, only vectors of exactly that many entries.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_list(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    good = pc.is_valid(column).to_numpy(zero_copy_only=False)
    if width is not None:
        good &= sizes == width
    flat = column.flatten()  # leaves out what null lists hold
    missing = pc.is_null(flat).to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    good[owner[missing | ~np.isfinite(values)]] = False
    return np.flatnonzero(good), sizes[good], values[good[owner]]


def as_lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of a matrix as a list column."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))


def matrix_of(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column whose rows all hold ``width`` numbers, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def blocks(values: np.ndarray) -> np.ndarray:
    """A flat array cut into rows of ``BLOCK`` numbers, the last one padded with zeros."""
    rows = -(-len(values) // BLOCK)
    out = np.zeros(rows * BLOCK, values.dtype)
    out[: len(values)] = values
    return out.reshape(rows, BLOCK)


def sum_blocks(df: DataFrame, keys: list[str], values: str = "part", kind: str | None = None) -> DataFrame:
    """Sums, place by place, of the arrays of ``BLOCK`` numbers that share ``keys``.

    Every task sums what it has before the shuffle, so one row a key and task is sent.
    """
    cells = [F.col(values)[i] for i in range(BLOCK)]
    sums = [F.sum(c.cast(kind) if kind else c).alias(f"s{i}") for i, c in enumerate(cells)]
    return df.groupBy(*keys).agg(*sums).select(*keys, F.array(*[f"s{i}" for i in range(BLOCK)]).alias(values))
