"""Vector columns: which vectors are usable, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column | str) -> Column:
    """True for a vector that is not null, has a length other than zero and only finite components."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def dimension(vectors: DataFrame, column: str) -> int:
    """Components of the usable vectors (0 without any); different lengths are an error."""
    return one_size(vectors.select(F.size(column).alias("size")))


def one_size(sizes: DataFrame) -> int:
    """The one ``size`` of all rows (0 without any); different ones are an error."""
    low, high = sizes.agg(F.min("size"), F.max("size")).first()
    if low != high:
        raise ValueError(f"vectors of {low} and of {high} components cannot be compared")
    return low or 0


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column, all of one length, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaling by the largest component first keeps squares in range."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.sum(rows * rows, axis=1, keepdims=True))
