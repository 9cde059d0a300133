"""Vectors as blocks of numbers in Python workers."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector, dim)`` with doubles. Null ids, and vectors that are null, empty or hold null or
    non-finite components, take no part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"),
        F.size("embedding").alias("dim"),
    )


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of lists of equal length as a matrix, one row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as held:
        return {name: held[name] for name in held.files}


def best(found: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest scores of each query, ties to smaller ids.

    Every block has kept its own ``k`` best already.
    """
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
