"""Components, clusters and densities over all dimensions of the embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabloom.operators import wide
from tabloom.plans.moments import mean_and_covariance
from tabloom.queries import fixtures as fx
from tabloom.queries.registry import query

#: The vectors of the smallest ids are the first centres.
FIRST = 3


def first_centres(spark, sf):
    rows = fx.vectors(spark, sf).orderBy("id").limit(FIRST).select("vec").collect()
    return [r["vec"] for r in rows]


CENTRES_SQL = f"""c0 AS MATERIALIZED (SELECT CAST(dense_rank() OVER (ORDER BY id) - 1 AS INTEGER) AS k, dim, value AS c FROM entries
    WHERE id IN (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT {FIRST}))"""


@query(
    "m24_covariance_wide",
    f"""WITH {fx.ENTRIES_SQL} SELECT CAST(a.dim AS INTEGER) AS i, CAST(b.dim AS INTEGER) AS j, round(covar_samp(a.value, b.value), 9) + 0.0 AS value
    FROM entries a JOIN entries b USING (id) WHERE a.dim <= b.dim GROUP BY 1, 2""",
)
def m24_covariance(spark, sf):
    return wide.covariance(fx.vectors(spark, sf), "vec").withColumn("value", F.round("value", 9) + 0.0)


@query(
    "m24_pca_wide",
    f"""WITH {fx.ENTRIES_SQL}, cov AS (SELECT a.dim AS i, b.dim AS j, covar_samp(a.value, b.value) AS c FROM entries a JOIN entries b USING (id) GROUP BY 1, 2)
    SELECT (SELECT count(DISTINCT dim) FROM entries) AS n, round(sum(c) FILTER (i = j), 8) AS trace, round(sum(c * c), 8) AS squares,
      0.0::DOUBLE AS skew, 0.0::DOUBLE AS residual FROM cov""",
)
def m24_pca(spark, sf):
    """All components: power sums of their variances, how far they are from orthonormal, and how far the
    projected rows' covariance is from the variances on a diagonal."""
    values, vectors, projected = wide.pca(fx.vectors(spark, sf), "vec")
    _, _, cov = mean_and_covariance(projected, "projection")
    skew, residual = np.abs(vectors.T @ vectors - np.eye(len(values))).max(), np.abs(cov - np.diag(values)).max()
    row = (len(values), round(float(values.sum()), 8), round(float((values**2).sum()), 8), round(float(skew), 8), round(float(residual), 8))
    return spark.createDataFrame([row], "n long, trace double, squares double, skew double, residual double")


def _lloyd_sql(rounds: int) -> str:
    steps = [f"WITH {fx.ENTRIES_SQL}, {CENTRES_SQL}"]
    for r in range(rounds):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT id, k, sum((value - c) * (value - c)) AS d FROM entries JOIN c{r} USING (dim) GROUP BY 1, 2),
        a{r} AS MATERIALIZED (SELECT id, k FROM d{r} QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, k) = 1),
        c{r + 1} AS MATERIALIZED (SELECT k, dim, avg(value) AS c FROM entries JOIN a{r} USING (id) GROUP BY 1, 2)""")
    last = f"(SELECT k, count(*) AS n FROM a{rounds - 1} GROUP BY 1)"
    return ", ".join(steps) + f" SELECT k AS cluster, CAST(dim AS INTEGER) AS dim, n, round(c, 6) + 0.0 AS value FROM c{rounds} JOIN {last} USING (k)"


@query("m27_kmeans_wide", _lloyd_sql(4))
def m27(spark, sf):
    centres, sizes = wide.kmeans(fx.vectors(spark, sf), "vec", first_centres(spark, sf), rounds=4)
    rows = [(k, d, int(sizes[k]), round(float(v), 6) + 0.0) for k in range(len(centres)) for d, v in enumerate(centres[k])]
    return spark.createDataFrame(rows, "cluster int, dim int, n long, value double")


@query(
    "m28_nearest_centre_wide",
    f"""WITH {fx.ENTRIES_SQL}, {CENTRES_SQL}, d AS (SELECT id, k, sum((value - c) * (value - c)) AS d FROM entries JOIN c0 USING (dim) GROUP BY 1, 2)
    SELECT id, k AS cluster, round(sqrt(d), 6) AS distance FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, k) = 1""",
)
def m28(spark, sf):
    out = wide.nearest_centre(fx.vectors(spark, sf), "vec", first_centres(spark, sf))
    return out.select("id", "cluster", F.round("distance", 6).alias("distance"))


@query(
    "m30_soft_kmeans_step_wide",
    f"""WITH {fx.ENTRIES_SQL}, {CENTRES_SQL}, v AS (SELECT dim, var_samp(x) AS v FROM (SELECT dim, value AS x FROM entries UNION ALL SELECT dim, c FROM c0) GROUP BY 1),
    w AS (SELECT id, k, exp(-0.2::DOUBLE * sqrt(sum((value - c) * (value - c) / v))) AS w FROM entries JOIN c0 USING (dim) JOIN v USING (dim) GROUP BY 1, 2),
    r AS (SELECT id, k, w / (sum(w) OVER (PARTITION BY id) + 1e-16::DOUBLE) AS r FROM w)
    SELECT k AS cluster, CAST(dim AS INTEGER) AS dim, round(sum(r * value) / sum(r), 6) + 0.0 AS value FROM r JOIN entries USING (id) GROUP BY 1, 2""",
)
def m30(spark, sf):
    centres = wide.soft_kmeans_step(fx.vectors(spark, sf), "vec", first_centres(spark, sf), 0.2)
    rows = [(k, d, round(float(v), 6) + 0.0) for k, centre in enumerate(centres) for d, v in enumerate(centre)]
    return spark.createDataFrame(rows, "cluster int, dim int, value double")


def _mixture_sql(rounds: int) -> str:
    steps = [f"""WITH {fx.ENTRIES_SQL}, {CENTRES_SQL}, v AS (SELECT dim, greatest(var_pop(value), 1e-6::DOUBLE) AS v FROM entries GROUP BY 1),
    w0 AS MATERIALIZED (SELECT DISTINCT k, 1 / {FIRST}::DOUBLE AS w FROM c0), t0 AS MATERIALIZED (SELECT k, dim, c AS m, v FROM c0 JOIN v USING (dim))"""]
    for r in range(rounds):
        steps.append(f"""l{r} AS MATERIALIZED (SELECT id, k, ln(max(w)) - 0.5 * sum((value - m) * (value - m) / v + ln(2 * pi() * v)) AS l
          FROM entries JOIN t{r} USING (dim) JOIN w{r} USING (k) GROUP BY 1, 2),
        e{r} AS MATERIALIZED (SELECT id, k, exp(l - max(l) OVER (PARTITION BY id)) AS e FROM l{r}),
        r{r} AS MATERIALIZED (SELECT id, k, e / sum(e) OVER (PARTITION BY id) AS r FROM e{r}),
        w{r + 1} AS MATERIALIZED (SELECT k, sum(r) / (SELECT count(*) FROM embeddings) AS w FROM r{r} GROUP BY 1),
        m{r} AS MATERIALIZED (SELECT k, dim, sum(r * value) / sum(r) AS m FROM r{r} JOIN entries USING (id) GROUP BY 1, 2),
        t{r + 1} AS MATERIALIZED (SELECT k, dim, max(m) AS m, greatest(sum(r * (value - m) * (value - m)) / sum(r), 1e-6::DOUBLE) AS v
          FROM r{r} JOIN entries USING (id) JOIN m{r} USING (k, dim) GROUP BY 1, 2)""")
    return ", ".join(steps) + f""" SELECT k AS component, CAST(dim AS INTEGER) AS dim, round(w, 6) AS weight, round(m, 6) + 0.0 AS mean, round(v, 6) AS variance
    FROM t{rounds} JOIN w{rounds} USING (k)"""


@query("m31_gaussian_mixture_wide", _mixture_sql(3))
def m31(spark, sf):
    weights, means, variances, _ = wide.gmm(fx.vectors(spark, sf), "vec", first_centres(spark, sf), 3)
    rows = [
        (k, d, round(float(weights[k]), 6), round(float(m), 6) + 0.0, round(float(v), 6))
        for k in range(len(weights)) for d, (m, v) in enumerate(zip(means[k], variances[k], strict=True))
    ]
    return spark.createDataFrame(rows, "component int, dim int, weight double, mean double, variance double")


@query("m36_gaussian_score_wide")
def m36(spark, sf):
    """A density over all dimensions; an inverse of that size has no SQL, the tests compare with numpy."""
    return wide.gaussian_score(fx.vectors(spark, sf), "vec").select("id", "score", "log_density")
