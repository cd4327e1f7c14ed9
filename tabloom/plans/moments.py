"""Sums of outer products over a table: the second moments of many dimensions at once.

One aggregate expression for each pair of dimensions makes plans of thousands of columns. Here a task
multiplies its rows, batch by batch, into one small matrix; its cells leave as rows, and a plain
aggregate with map-side combining adds them up. What moves depends on tasks and cells, not on rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that a task holds and that ``outer_matrix`` brings to the driver, at most (8 MB).
MOST_CELLS = 1 << 20

_CELLS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.float64()), ("width", pa.int64())])


def matrix_of(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists as one matrix."""
    lengths = pc.min_max(pc.list_value_length(column)).as_py()
    if lengths["min"] != lengths["max"]:
        raise ValueError("arrays of different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(column), -1)


def whole(column: Column) -> Column:
    """Whether an array is there and no entry of it is missing."""
    return column.isNotNull() & ~F.exists(column, lambda x: x.isNull())


def outer_sums(df: DataFrame, left: Column, right: Column) -> DataFrame:
    """(i, j, value): the sum over the rows of left[i] * right[j], for two arrays of doubles.

    Rows where an array is null or holds a null take no part. Lengths that differ within one side
    raise an error, and so do more cells than ``MOST_CELLS``. No rows give no cells.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            if part.num_rows == 0:
                continue
            a, b = (matrix_of(c) for c in part.columns)
            if a.shape[1] * b.shape[1] > MOST_CELLS:
                raise ValueError(f"{a.shape[1]} x {b.shape[1]} cells are too many for a task; see plans.sketch")
            if total is not None and total.shape != (a.shape[1], b.shape[1]):
                raise ValueError("arrays of different lengths")
            total = a.T @ b if total is None else total + a.T @ b
        if total is not None:
            i, j = np.indices(total.shape, np.int32)
            width = np.full(total.size, total.shape[0] << 32 | total.shape[1], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c.ravel()) for c in (i, j, total, width)], schema=_CELLS)

    rows = df.select(left.cast("array<double>").alias("left"), right.cast("array<double>").alias("right"))
    cells = rows.filter(whole(F.col("left")) & whole(F.col("right"))).mapInArrow(work, "i int, j int, value double, width long")
    # Cell (0, 0) is in every task, so tasks whose arrays differ meet there.
    sums = cells.groupBy("i", "j").agg(F.sum("value").alias("value"), F.min("width").alias("least"), F.max("width").alias("most"))
    odd = F.raise_error(F.lit("arrays of different lengths")).cast("double")
    return sums.select("i", "j", F.when(F.col("least") == F.col("most"), F.col("value")).otherwise(odd).alias("value"))


def outer_matrix(df: DataFrame, left: Column, right: Column) -> np.ndarray:
    """``outer_sums`` as a matrix on the driver, at most ``MOST_CELLS`` numbers; no rows give one of shape (0, 0)."""
    cells = outer_sums(df, left, right).toPandas()
    if cells.empty:
        return np.zeros((0, 0))
    out = np.zeros((int(cells["i"].max()) + 1, int(cells["j"].max()) + 1))
    out[cells["i"], cells["j"]] = cells["value"]
    return out


def mean_and_covariance(df: DataFrame, vector: str, ddof: int = 1) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, covariance) in two passes: the rows are centred before they are multiplied."""
    vec, one = F.col(vector).cast("array<double>"), F.array(F.lit(1.0))
    sums = outer_matrix(df, one, F.concat(one, vec))
    if not sums.size:
        raise ValueError("no row has a whole vector")
    n, mean = int(sums[0, 0]), sums[0, 1:] / sums[0, 0]
    centred = F.zip_with(vec, F.lit(mean.tolist()), lambda x, m: x - m)
    return n, mean, outer_matrix(df, centred, centred) / max(1, n - ddof)
