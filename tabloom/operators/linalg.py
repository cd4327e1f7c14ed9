"""Linear algebra on tables: matrices are ``(i, j, value)`` triplets or rows of arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.plans import KeyedLinks, block_product, checkpointed, row_number_within, written

# --- products -------------------------------------------------------------------------------


def spmv(matrix: DataFrame, x: DataFrame) -> DataFrame:
    """(i, value): sparse matrix (i, j, value) times vector (j, x).

    One row per entry; sums are combined before the shuffle, and a heavy column is split by
    adaptive execution since the vector holds one row per index.
    """
    products = matrix.join(x.select("j", "x"), "j")
    return products.groupBy("i").agg(F.sum(F.col("value") * F.col("x")).alias("value"))


def spmv_t(matrix: DataFrame, x: DataFrame) -> DataFrame:
    """(j, value): the transposed matrix times vector (i, x)."""
    turned = matrix.select(F.col("j").alias("i"), F.col("i").alias("j"), "value")
    return spmv(turned, x.select(F.col("i").alias("j"), "x")).withColumnRenamed("i", "j")


def matmul(a: DataFrame, b: DataFrame) -> DataFrame:
    """(i, j, value): product of two triplet tables, by blocks."""
    left = a.select("i", F.col("j").alias("k"), F.col("value").alias("a"))
    right = b.select(F.col("i").alias("k"), "j", "value")
    return block_product(left, right, ["value"])


# --- least squares --------------------------------------------------------------------------


def gram_solve(df: DataFrame, columns: Sequence[str], target: str) -> list[float]:
    """Intercept and slopes of least squares from one pass of Gram sums.

    The sums are (columns + 1) squared numbers; the solve picks the shortest solution, so
    dependent columns are allowed.
    """
    terms = [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]
    d = len(terms)
    sums = df.agg(
        *[F.sum(terms[r] * terms[c]).alias(f"g{r}_{c}") for r in range(d) for c in range(r, d)],
        *[F.sum(terms[r] * F.col(target)).alias(f"y{r}") for r in range(d)],
    ).first()
    gram = np.array([[sums[f"g{min(r, c)}_{max(r, c)}"] for c in range(d)] for r in range(d)])
    right = np.array([sums[f"y{r}"] for r in range(d)])
    scale = 1.0 / np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    solved = np.linalg.lstsq(gram * np.outer(scale, scale), right * scale, rcond=1e-12)[0]
    return [float(v) for v in solved * scale]


# --- principal components, low rank -----------------------------------------------------------


def pca(df: DataFrame, vector: str, k: int, corr: bool = False):
    """(model, projected rows with ``projection``): PCA of the covariance or correlation matrix."""
    scaler = StandardScaler(withMean=True, withStd=corr, inputCol=vector, outputCol="_scaled").fit(df)
    scaled = scaler.transform(df)
    model = PCA(k=k, inputCol="_scaled", outputCol="projection").fit(scaled)
    return model, model.transform(scaled).drop("_scaled")


def low_rank(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Rank-k approximation of a matrix given as ``(id, vec array<double>)``.

    Returns ``(id, vec)`` of ``A V Vt`` and one row (rank, ratio, error): numbers kept over
    numbers stored, and the relative Frobenius error. Only V, columns x k, visits the driver.
    """
    vectors = rows.select(array_to_vector("vec").alias("v"))
    svd = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeSVD(k)
    v = svd.V.toArray()
    n_cols, rank = v.shape

    @F.pandas_udf("array<double>")
    def rebuild(vec: pd.Series) -> pd.Series:
        a = np.stack(vec.to_numpy())
        return pd.Series(list(a @ v @ v.T))

    near = rows.select("id", "vec", rebuild("vec").alias("near"))

    def square(col):
        return F.aggregate(col, F.lit(0.0), lambda acc, x: acc + x * x)

    gap = F.zip_with("vec", "near", lambda a, b: a - b)
    stats = near.agg(
        F.lit(rank).alias("rank"),
        (F.lit(rank) * (F.count(F.lit(1)) + n_cols + 1) / (F.count(F.lit(1)) * n_cols)).alias("ratio"),
        F.sqrt(F.sum(square(gap)) / F.sum(square(F.col("vec")))).alias("error"),
    )
    return near.select("id", F.col("near").alias("vec")), stats


# --- PageRank -------------------------------------------------------------------------------


def pagerank(edges: DataFrame, m: float = 0.15, tol: float = 1e-9, max_iter: int = 50) -> DataFrame:
    """(node, rank) with ranks summing to 1; a node without out-edges spreads its rank evenly.

    The links are laid out by source once; a round sends the ranks (one row per node) to them
    and sums per target before the shuffle, so neither a node with many in-edges nor one with
    many out-edges fills a task. Rounds end in checkpoints, and two sums decide whether to go on.
    """
    links = KeyedLinks(edges.select("src", "dst"), "src")
    degrees = links.table.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("_deg"))
    nodes = links.table.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    nodes = written(nodes.join(degrees, "node", "left").select("node", "_deg"), "nodes")
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_deg").isNull()).alias("loose")).first()
    n, loose = size["n"], size["loose"] / max(size["n"], 1)
    ranks = nodes.withColumn("rank", F.lit(1.0 / max(n, 1)))
    for _ in range(max_iter if n else 0):
        out = ranks.filter("_deg IS NOT NULL").select(F.col("node").alias("src"), (F.col("rank") / F.col("_deg")).alias("_out"))
        gained = links.send(out).groupBy(F.col("dst").alias("node")).agg(F.sum("_out").alias("_in"))
        base = (m + (1 - m) * loose) / n
        new = ranks.withColumnRenamed("rank", "_old").join(gained, "node", "left").select(
            "node", "_deg", "_old", (F.lit(base) + (1 - m) * F.coalesce("_in", F.lit(0.0))).alias("rank")
        )
        new = checkpointed(new)
        state = new.agg(
            F.max(F.abs(F.col("rank") - F.col("_old"))).alias("moved"),
            F.coalesce(F.sum(F.when(F.col("_deg").isNull(), F.col("rank"))), F.lit(0.0)).alias("loose"),
        ).first()
        ranks, loose = new.drop("_old"), state["loose"]
        if state["moved"] < tol:
            break
    links.close()
    return ranks.select("node", "rank")


# --- Kalman filter --------------------------------------------------------------------------


def _next_gains(state: tuple[float, ...], theta1: float, theta2: float) -> tuple[float, ...]:
    """One step of the gain recursion, which depends on the step only, not on the data.

    A state holds the covariances p, q, s of the two terms that move up by one place each step, the
    two gains of the last step, and the second gain of the step before it.
    """
    p, q, s, _, before, _ = state
    g1, g2 = (q + theta1) / (p + 1.0), theta2 / (p + 1.0)
    return (s + theta1 * theta1 - g1 * (q + theta1), theta1 * theta2 - g1 * theta2, theta2 * theta2 - g2 * theta2, g1, g2, before)


def _gain_states(theta1: float, theta2: float, start: float, steps: int, every: int) -> list[tuple[float, ...]]:
    """States at every so many steps; the last one holds for all later steps if the gains stand still."""
    state, before, states = (start, 0.0, start, 0.0, 0.0, 0.0), None, []
    for step in range(steps):
        if step % every == 0:
            states.append(state)
        state, before, older = _next_gains(state, theta1, theta2), state, before
        if state in (before, older):  # also when it swings by a rounding
            states.append(state)
            break
    return states


def _run_chunk(values, gains, e1: float, e2: float):
    """Innovations of one chunk from the two innovations before it: e = y - g1 e1 - g2 e2."""
    out = np.empty(len(values))
    for n, (y, (g1, g2)) in enumerate(zip(values, gains, strict=True)):
        out[n] = y - g1 * e1 - g2 * e2
        e1, e2 = out[n], e1
    return out


def kalman_ma(
    series: DataFrame,
    theta1: float,
    theta2: float,
    *,
    key: str = "series",
    order: Sequence[str] = ("t", "id"),
    value: str = "value",
    start: float = 1e7,
    chunk_rows: int = 50_000,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``at`` (place in the series) and ``forecast``: one-step MA(2) Kalman forecasts.

    Values are centred by the series mean, filtered from a diffuse start, and the mean is put
    back. The filter is linear in the two innovations before a chunk, so every chunk first
    reports how it carries them on, the chunks of a series are chained over those few numbers,
    and then all chunks run at once: a long series is not bound to one task.
    """
    means = series.groupBy(key).agg(F.avg(value).alias("_mean"))
    placed = row_number_within(series, [key], list(order), "at", hot_rows).join(means, key)
    placed = placed.withColumn("_x", F.col(value) - F.col("_mean")).withColumn("_chunk", F.expr(f"(at - 1) div {chunk_rows}"))
    placed = written(placed, "series")
    longest = placed.agg(F.max("at")).first()[0] or 0
    states = _gain_states(theta1, theta2, start, longest, chunk_rows)

    def gains_of(chunk: int, n: int) -> list[tuple[float, float]]:
        state, out = states[min(chunk, len(states) - 1)], []
        for _ in range(n):
            out.append((state[3], state[5]))
            state = _next_gains(state, theta1, theta2)
        return out

    def carry(keys, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        x, gains = pdf["_x"].to_numpy(), gains_of(int(keys[1]), len(pdf))
        zeros = np.zeros(len(x))
        own = _run_chunk(x, gains, 0.0, 0.0)
        from1 = _run_chunk(zeros, gains, 1.0, 0.0)
        from2 = _run_chunk(zeros, gains, 0.0, 1.0)

        def ends(e, before1, before2):
            return [e[-1], e[-2] if len(e) > 1 else before1]

        row = [keys[0], int(keys[1]), *ends(own, 0.0, 0.0), *ends(from1, 1.0, 0.0), *ends(from2, 0.0, 1.0)]
        return pd.DataFrame([row], columns=["_key", "_chunk", "c1", "c2", "a11", "a21", "a12", "a22"])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        e, rows = np.zeros(2), []
        for r in pdf.itertuples(index=False):
            rows.append((r[0], r[1], e[0], e[1]))
            e = np.array([r.c1, r.c2]) + np.array([[r.a11, r.a12], [r.a21, r.a22]]) @ e
        return pd.DataFrame(rows, columns=["_key", "_chunk", "e1", "e2"])

    def run(keys, pdf: pd.DataFrame, begin: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        x, gains = pdf["_x"].to_numpy(), gains_of(int(pdf["at"].iloc[0] - 1) // chunk_rows, len(pdf))
        e = _run_chunk(x, gains, float(begin["e1"].iloc[0]), float(begin["e2"].iloc[0]))
        return pd.DataFrame({"_key": pdf[key], "at": pdf["at"], "_f": x - e})

    key_type = series.schema[key].dataType.simpleString()
    steps = placed.select(key, "_chunk", "at", "_x")
    maps = steps.groupBy(key, "_chunk").applyInPandas(
        carry, f"_key {key_type}, _chunk long, c1 double, c2 double, a11 double, a21 double, a12 double, a22 double"
    )
    starts = maps.groupBy("_key").applyInPandas(chain, f"_key {key_type}, _chunk long, e1 double, e2 double")
    starts = starts.withColumnRenamed("_key", key)
    filtered = steps.groupBy(key, "_chunk").cogroup(starts.groupBy(key, "_chunk")).applyInPandas(
        run, f"_key {key_type}, at long, _f double"
    )
    back = filtered.withColumnRenamed("_key", key)
    return placed.join(back, [key, "at"]).select(
        *series.columns, "at", (F.col("_f") + F.col("_mean")).alias("forecast")
    )
