"""Vector expressions: norm, safe normalisation, cosine against one vector.

Vectors are ``array<float>`` columns; arithmetic is done in double. The work is
done on Arrow batches as whole matrices, because higher-order functions run the
same sums interpreted, element by element (three to five times slower on
400,000 x 128 floats, scan included).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: added to every norm before dividing, so a zero vector stays zero.
EPSILON = 1e-12

# Similarities are compared at this many decimals. Sums taken in another order
# differ in the last bits; rounding makes copies of a vector tie wherever they lie.
TIE_DECIMALS = 9


def as_matrix(vectors: pa.Array) -> np.ndarray:
    """An Arrow list array as a float64 matrix; rows must agree in length.

    Null rows and null elements become NaN.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = len(vectors)
    filled = vectors.drop_null() if vectors.null_count else vectors
    sizes = np.unique(filled.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of unequal length: {sizes.tolist()}")
    dim = int(sizes[0]) if len(sizes) else 0
    values = filled.flatten().to_numpy(zero_copy_only=False)
    rows = values.reshape(len(filled), dim).astype(np.float64)
    if len(filled) == n:
        return rows
    out = np.full((n, dim), np.nan)
    out[vectors.is_valid().to_numpy(zero_copy_only=False)] = rows
    return out


def to_lists(matrix: np.ndarray) -> pa.Array:
    """A matrix as an Arrow list array of float32."""
    n, dim = matrix.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * dim, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32).ravel(), pa.float32()))


def row_norms(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", matrix, matrix))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / (row_norms(matrix) + EPSILON)[:, None]


def _masked(values: pa.Array, like: pa.Array) -> pa.Array:
    """``values`` with nulls where ``like`` has them."""
    if not like.null_count:
        return values
    return pc.if_else(like.is_valid(), values, pa.scalar(None, values.type))


@F.arrow_udf(T.DoubleType())
def _norm(vectors: pa.Array) -> pa.Array:
    return _masked(pa.array(row_norms(as_matrix(vectors)), pa.float64()), vectors)


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _normalize(vectors: pa.Array) -> pa.Array:
    return _masked(to_lists(unit_rows(as_matrix(vectors))), vectors)


def as_float(vector: Column) -> Column:
    """The vector in single precision."""
    return vector.cast("array<float>")


def norm(vector: Column) -> Column:
    """L2 norm."""
    return _norm(vector)


def normalize(vector: Column) -> Column:
    """``v / (norm + 1e-12)``; a zero vector stays zero."""
    return _normalize(vector)


def cosine_to(query: np.ndarray, vector: Column) -> Column:
    """Cosine similarity of every vector with one query vector."""
    unit = unit_rows(np.asarray(query, dtype=np.float64).reshape(1, -1))[0]

    @F.arrow_udf(T.DoubleType())
    def cosine(vectors: pa.Array) -> pa.Array:
        return _masked(pa.array(unit_rows(as_matrix(vectors)) @ unit, pa.float64()), vectors)

    return cosine(vector)
