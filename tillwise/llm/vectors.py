"""Vectors that can be compared: not null, of finite components, with a length above zero."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def comparable(vector: Column) -> Column:
    """True for a vector that has a direction."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Doubles, a row per vector; all must have one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 1)


def units(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``; equal rows give equal numbers wherever they stand."""
    lengths = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    return (a * b).sum(axis=1) / lengths
