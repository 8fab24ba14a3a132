"""Vector columns as numpy matrices, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whole components beyond this size would not fit the long results.
LARGEST = 2**24


def finite(vec: Column) -> Column:
    """True for a vector that is there and whose components all are, and are finite."""
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))), F.lit(False))


def whole(vec: Column, scale: int = 256) -> Column:
    """array<long> of floor(scale * x), x as double. A component beyond
    ``LARGEST`` is an error: sums of products would no longer be exact."""
    def part(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double")) * scale <= LARGEST, scaled).otherwise(
            F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}")).cast("long"))

    return F.transform(vec, part)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int, dtype=np.int64) -> np.ndarray:
    """Rows of a list column; a vector shorter than ``dim`` counts as ended
    by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    if len(flat) == len(column) * dim:
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        if (lengths == dim).all():
            return flat.reshape(len(column), dim)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dim), dtype)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out
