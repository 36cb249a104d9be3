"""Usable vectors and their classes of equal vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """id, vec (array<double>), dim, h (64-bit key of vector and ``more``) of rows whose vector
    isn't null, empty or zero and holds only finite numbers; rows without an id are left out."""
    vec = F.col(vec_col).cast("array<double>")
    ok = (F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()
          & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
          & F.exists(vec, lambda x: x != 0))
    plain = F.transform(vec, lambda x: x + F.lit(0.0))  # -0.0 is 0.0
    keyed = vectors.where(F.coalesce(ok, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), plain.alias("vec"), *[F.col(m) for m in more])
    return keyed.withColumn("dim", F.size("vec")).withColumn("h", F.xxhash64("vec", *more))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, in double precision."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
