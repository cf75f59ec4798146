"""Vector columns: which rows take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Not null, at least one component, all of them finite, not all zero; never null itself."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(column).isNotNull() & ~bad & F.exists(column, lambda x: x != 0), F.lit(False))


def as_double(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) with double components; other columns are left out."""
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column whose lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1))


def norms(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v * v).sum(axis=1))
