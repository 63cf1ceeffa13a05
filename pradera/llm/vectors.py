"""Vector columns: which take part, and matrices of them inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce(v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Double-precision rows of a list column; shorter vectors are filled up with zeros."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = a.chunk(0) if a.num_chunks else pa.array([], a.type)
    size = a.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = a.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(size), width))
    if len(size):
        col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(np.arange(len(size)), size), col] = flat
    return out


def unit_rows(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    x = x / np.where(scale > 0, scale, 1.0)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)
