"""What the two vector operators share: which vectors take part, and exact cosines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def chosen(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of all rows; the vector is an array of float if it was one, which
    is half as much to move, else of double."""
    narrow = vectors.schema[vector_column].dataType == T.ArrayType(T.FloatType())
    vector = F.col(f"`{vector_column}`").cast("array<float>" if narrow else "array<double>")
    return vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), vector.alias("vector"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1) if rows else np.empty((0, 0))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision. Equal rows give equal sums wherever they stand,
    which a matrix product does not promise. Rows are scaled by powers of two, which is
    exact, so that no square is too large or too small."""
    return np.add.reduce(a * b, axis=1)


def scaled(a: np.ndarray) -> np.ndarray:
    largest = np.abs(a).max(axis=1, keepdims=True)
    return np.ldexp(a, -np.frexp(np.where(largest > 0, largest, 1.0))[1])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = scaled(a), scaled(b)
    return dots(a, b) / np.sqrt(dots(a, a) * dots(b, b))


def unit(a: np.ndarray) -> np.ndarray:
    a = scaled(a)
    return a / np.sqrt(dots(a, a))[:, None]
