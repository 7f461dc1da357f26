"""Embedding columns: which vectors take part, and their values as arrays."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def takes_part(vector: Column) -> Column:
    """False for null, empty and zero vectors and those with null or non-finite components."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v.isNotNull() & (v != 0)), F.lit(False))


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector takes part, with components as double."""
    return vectors.withColumn(column, F.transform(column, lambda v: v.cast("double"))).filter(takes_part(F.col(column)))


def matrix(column) -> np.ndarray:
    """The values of a list column whose lists have one length, a row for each list."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
