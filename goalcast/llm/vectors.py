"""Vector tables: valid rows, blocks of rows as matrices, and merging of per-block best lists."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid_vectors(df: DataFrame, nonzero: bool) -> DataFrame:
    """``(row, vec_id, v array<double>)``: every row with a non-null vec_id, numbered, without
    vectors that are null, empty, hold null or non-finite components, or (on request) only zeros.
    The numbers hold once the result is written."""
    v = F.col("embedding").cast("array<double>")
    rows = (df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))
    if nonzero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")


def by_length(rows: DataFrame, search: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    """``search`` over the vectors of each length by themselves, side by side: vectors of different
    lengths have no product."""
    lengths = [r[0] for r in rows.select(F.size("v")).distinct().collect()]    # one number per length
    parts = [search(rows.where(F.size("v") == d) if len(lengths) > 1 else rows) for d in sorted(lengths)]
    return reduce(DataFrame.union, parts) if parts else rows.sparkSession.createDataFrame([], schema)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0))


def best_rows(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by (score descending, id ascending)."""
    return np.lexsort((ids, -score))[:k]


def merge_best(found: DataFrame, k: int, *then: Column) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of each query row's per-block lists
    (``query`` is the number of the row; k rows a block at most); equal scores go by ``then``."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), *then, "vec_id")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
