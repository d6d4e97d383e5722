"""Embedding vectors as whole numbers, and as matrices in Python workers."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id`` (bigint) and ``x``: every component as a double, times ``scale``, rounded down to a long.

    Vectors that are null, or that hold a null or non-finite component, are left out. A
    null id is kept; any other column is left behind. Products beyond a long are held at its ends.
    """
    c = df[vector_col].cast("array<double>")
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    x = F.transform(c, lambda v: F.floor(v * F.lit(float(scale))))
    return df.where(c.isNotNull() & finite).select(df[id_col].cast("bigint").alias("vec_id"), x.alias("x"))


def matrix(batch: pa.RecordBatch, dims: int, name: str = "x") -> np.ndarray:
    """The vectors of a batch as rows; a shorter one has zeros in its missing places."""
    lists = batch.column(batch.schema.get_field_index(name))
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return values.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, places] = values
    return out


def largest(values: np.ndarray) -> int:
    """The largest magnitude, as a Python number (the least long has no counterpart among longs)."""
    return max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0
