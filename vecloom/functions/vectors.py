"""Vector columns, and the passage of vectors between Arrow and numpy."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def to_lists(matrix: np.ndarray) -> pa.ListArray:
    """A (n, dim) matrix as an Arrow list column of float32."""
    n, dim = matrix.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix, dtype=np.float32).ravel()))


def to_matrix(lists: pa.ListArray, dim: int) -> np.ndarray:
    """An Arrow list column as a (n, dim) matrix; raises when a row has another length."""
    lengths = lists.value_lengths()
    if lengths.null_count or (len(lists) and (lengths.to_numpy() != dim).any()):
        raise ValueError(f"vector dimension mismatch: expected {dim}")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; zero rows stay zero."""
    wide = matrix.astype(np.float64)
    norms = np.sqrt(np.cumsum(wide * wide, axis=1)[:, -1:]) if wide.shape[1] else np.ones((len(wide), 1))
    return wide / np.where(norms > 0, norms, 1.0)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def normalize(vector: Column) -> Column:
    """L2-normalised float32 vector; a zero vector is returned unchanged. Rows may differ in length."""
    narrow = vector.cast("array<float>")

    def scaled(length: Column) -> Column:
        unit = F.transform(narrow, lambda x: (x.cast("double") / length).cast("float"))
        return F.when(length > 0, unit).otherwise(narrow)

    # The one-element array makes the length a lambda variable: computed once per vector, not once per element.
    return F.element_at(F.transform(F.array(norm(narrow)), scaled), 1)


def is_finite(vector: Column) -> Column:
    """Whether no element is null, NaN or infinite. NaN is the largest number to Spark."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def wrong_dimension(vector: Column, dim: int) -> Column:
    return F.coalesce(F.size(vector) != dim, F.lit(True))


def fault(vector: Column, dim: int) -> Column:
    """Why a vector cannot be stored - ``missing``, ``length`` or ``not finite`` - or null."""
    missing = F.coalesce(F.size(vector) < 1, F.lit(True))
    return F.when(missing, "missing").when(F.size(vector) != dim, "length").when(~is_finite(vector), "not finite")
