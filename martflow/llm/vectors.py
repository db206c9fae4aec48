"""What the vector operators share: which vectors take part, and tiles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id long, v array<double>`` of the vectors that take part: not null
    or empty, no null or non-finite component, not all zero, id not null."""
    v = F.col(vector).cast("array<double>")
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .where(F.exists("v", lambda x: x != 0.0)))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix; all rows have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed from left to right: equal rows give equal
    bits wherever they are."""
    return np.cumsum(a * b, axis=1)[:, -1] if a.shape[1] else np.zeros(len(a))
