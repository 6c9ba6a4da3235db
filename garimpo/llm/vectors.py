"""Rows of embedding tables: which vectors take part, and Arrow batches of vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id long, v array<double>): rows whose vector holds finite numbers only and has the usual length.

    Null vectors and vectors with a null, infinite or NaN entry are left out, and so are empty ones. The
    usual length is the most frequent one, of equally frequent ones the largest; others are left out too.
    """
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter(
        (F.size("v") > 0) & ~odd)
    usual = sound.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return sound.filter(F.size("v") == (usual[0].d if usual else 0))


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """An Arrow column of lists of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1 if len(column) else 0).astype(kind, copy=False)


def nonzero(vector: Column) -> Column:
    return F.exists(vector, lambda x: x != 0)
