"""Vector columns: which rows take part, and their Arrow batches as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cartwheel.llm import text as T


def finite(column: str) -> str:
    """SQL: the list is there and holds neither nulls nor NaN nor infinities."""
    return f"{column} is not null and forall({column}, x -> x is not null and abs(x) < double('Infinity'))"


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` doubles each, as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def packed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def unpacked(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """What ``packed`` made, as a matrix again."""
    return np.array(T.utf8(column)[0]).view(kind).reshape(-1, width)
