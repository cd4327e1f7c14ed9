"""Clusters, components and densities of points of many dimensions, kept in one array column.

The siblings in ``cluster`` and ``linalg`` take a column for each dimension. These take an array of any
length up to a thousand: every round is one pass that multiplies arrays in the tasks (``plans.moments``),
and the plan's size does not depend on the number of dimensions. Rows whose vector is null or holds a
null take no part in fits and get null results.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.plans.moments import mean_and_covariance, outer_matrix, whole


def _mapped(vector: str, fn: Callable[[np.ndarray], np.ndarray]) -> Column:
    """``fn`` of the matrix of a batch's vectors, row by row an array; null where the vector isn't whole."""

    @F.pandas_udf("array<double>")
    def apply(vec: pd.Series) -> pd.Series:
        there = vec.notna().to_numpy()
        out: list[np.ndarray | None] = [None] * len(vec)
        if there.any():
            for i, row in zip(np.flatnonzero(there), fn(np.stack(vec[there].to_numpy())), strict=True):
                out[i] = row
        return pd.Series(out, dtype=object)

    vec = F.col(vector).cast("array<double>")
    return apply(F.when(whole(vec), vec))


def _squares(rows: np.ndarray, centres: np.ndarray, scale: np.ndarray | float = 1.0) -> np.ndarray:
    """Squared distance of every row to every centre, each dimension divided by its scale."""
    return np.stack([((rows - c) ** 2 / scale).sum(axis=1) for c in centres], axis=1)


# --- components -----------------------------------------------------------------------------


def covariance(df: DataFrame, vector: str, ddof: int = 1) -> DataFrame:
    """(i, j, value) for i <= j: the covariance of the dimensions, counted from 0."""
    _, _, cov = mean_and_covariance(df, vector, ddof)
    i, j = np.triu_indices(len(cov))
    return df.sparkSession.createDataFrame(pd.DataFrame({"i": i, "j": j, "value": cov[i, j]}), "i int, j int, value double")


def pca(df: DataFrame, vector: str, k: int | None = None, corr: bool = False) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """(variances, components as columns, rows with ``projection``), by falling variance.

    The largest entry of a component is positive. With ``corr`` dimensions are divided by their
    deviation; those without any stay 0.
    """
    _, mean, cov = mean_and_covariance(df, vector)
    width = np.sqrt(np.diag(cov)) if corr else np.ones(len(mean))
    inverse = np.divide(1.0, width, where=width > 0, out=np.zeros_like(width))
    values, vectors = np.linalg.eigh(cov * np.outer(inverse, inverse))
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    projected = df.withColumn("projection", _mapped(vector, lambda x: ((x - mean) * inverse) @ vectors))
    return values, vectors, projected


# --- centres --------------------------------------------------------------------------------


def nearest_centre(df: DataFrame, vector: str, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``cluster`` (first nearest centre) and ``distance``."""
    at = np.array(centres, float)
    far = df.withColumn("_far", _mapped(vector, lambda x: _squares(x, at)))
    best = F.array_min("_far")
    return far.select(*df.columns, (F.array_position("_far", best) - 1).cast("int").alias("cluster"), F.sqrt(best).alias("distance"))


def kmeans(df: DataFrame, vector: str, centres: Sequence[Sequence[float]], rounds: int = 20, tol: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(centres, their rows in the last assignment) by Lloyd's rounds from given centres.

    Ends when no centre moves by more than ``tol``. A centre without rows stays where it is.
    """
    at = np.array(centres, float)
    one, vec = F.array(F.lit(1.0)), F.col(vector).cast("array<double>")
    sizes = np.zeros(len(at))
    for _ in range(rounds):
        before = at
        hot = _mapped(vector, lambda x, at=before: np.eye(len(at))[_squares(x, at).argmin(axis=1)])
        sums = outer_matrix(df, hot, F.concat(one, vec))
        if not sums.size:
            break
        sizes = sums[:, 0]
        at = np.where(sizes[:, None] > 0, sums[:, 1:] / np.maximum(sizes, 1)[:, None], before)
        if np.abs(at - before).max() <= tol:
            break
    return at, sizes.astype(np.int64)


def soft_kmeans_step(df: DataFrame, vector: str, centres: Sequence[Sequence[float]], beta: float) -> np.ndarray:
    """New centres from responsibilities ``exp(-beta d)`` scaled to sum 1 per point.

    d is the distance with each dimension divided by its sample variance over points and centres together.
    """
    at = np.array(centres, float)
    one, vec = F.array(F.lit(1.0)), F.col(vector).cast("array<double>")
    n, mean, cov = mean_and_covariance(df, vector, ddof=0)
    # Variance of the points and the centres, put together from both parts' own.
    both = n + len(at)
    middle = (n * mean + at.sum(axis=0)) / both
    variance = (n * (np.diag(cov) + (mean - middle) ** 2) + ((at - middle) ** 2).sum(axis=0)) / (both - 1)

    def shares(x: np.ndarray) -> np.ndarray:
        weight = np.exp(-beta * np.sqrt(_squares(x, at, variance)))
        return weight / (weight.sum(axis=1, keepdims=True) + 1e-16)

    sums = outer_matrix(df, _mapped(vector, shares), F.concat(one, vec))
    return sums[:, 1:] / (sums[:, :1] + 1e-16)


# --- densities ------------------------------------------------------------------------------


def gmm(df: DataFrame, vector: str, means: Sequence[Sequence[float]], rounds: int = 20, floor: float = 1e-6):
    """Diagonal Gaussian mixture by EM from given means: (weights, means, variances, log-likelihood per round)."""
    _, middle, cov = mean_and_covariance(df, vector, ddof=0)
    at = np.array(means, float) - middle  # sums of squares lose less about the common mean
    k = len(at)
    weights, variances = np.full(k, 1.0 / k), np.tile(np.maximum(np.diag(cov), floor), (k, 1))
    vec = F.zip_with(F.col(vector).cast("array<double>"), F.lit(middle.tolist()), lambda x, m: x - m)
    terms = F.concat(F.array(F.lit(1.0)), vec, F.transform(vec, lambda x: x * x))
    history = []
    for _ in range(rounds):

        def shares(x: np.ndarray, weights=weights, at=at, variances=variances) -> np.ndarray:
            x = x - middle
            logs = np.stack([
                np.log(max(w, 1e-300)) - 0.5 * ((x - m) ** 2 / v + np.log(2 * np.pi * v)).sum(axis=1)
                for w, m, v in zip(weights, at, variances, strict=True)
            ], axis=1)
            top = logs.max(axis=1, keepdims=True)
            each = top + np.log(np.exp(logs - top).sum(axis=1, keepdims=True))
            return np.hstack([np.exp(logs - each), each])

        sums = outer_matrix(df, _mapped(vector, shares), terms)
        history.append(float(sums[k, 0]))
        mass = np.maximum(sums[:k, :1], 1e-300)
        first, second = np.hsplit(sums[:k, 1:] / mass, 2)
        weights, at, variances = sums[:k, 0] / sums[:k, 0].sum(), first, np.maximum(second - first**2, floor)
    return weights, at + middle, variances, history


def gaussian_score(df: DataFrame, vector: str) -> DataFrame:
    """Add ``score`` (minus half the squared Mahalanobis distance) and ``log_density`` of one Gaussian.

    Directions without any spread are left out of both.
    """
    _, mean, cov = mean_and_covariance(df, vector, ddof=0)
    values, vectors = np.linalg.eigh(cov)
    some = values > values.max() * 1e-12
    half = vectors[:, some] / np.sqrt(values[some])
    scale = -0.5 * float(np.log(2 * np.pi * values[some]).sum())
    scored = df.withColumn("_score", _mapped(vector, lambda x: -0.5 * (((x - mean) @ half) ** 2).sum(axis=1, keepdims=True)))
    score = F.col("_score")[0]
    return scored.select(*df.columns, score.alias("score"), (score + scale).alias("log_density"))
