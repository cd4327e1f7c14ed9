"""Evaluation, clustering and linear algebra."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import cluster, linalg
from tabloom.operators import evaluate as ev
from tabloom.plans.laplacian import half_walk, laplacian_vectors
from tabloom.plans.sketch import singular_vectors, times
from tabloom.queries import fixtures as fx
from tabloom.queries.registry import query, table

CALLED_SQL = f"{fx.SCORED_SQL}, called AS (SELECT *, (score > 800)::INT AS prediction FROM scored)"


@query(
    "m15_binary_metrics",
    f"""WITH {CALLED_SQL}, c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
      count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM called)
    SELECT *, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
      round(tn / (tn + fp), 6) AS specificity, round(tn / (tn + fn), 6) AS npv, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
)
def m15(spark, sf):
    out = ev.binary_metrics(fx.scored(spark, sf).withColumn("prediction", (F.col("score") > 800).cast("int")))
    return out.select("tp", "fp", "tn", "fn", *[F.round(c, 6).alias(c) for c in out.columns[4:]])


@query(
    "m16_roc_curve",
    f"""WITH {fx.SCORED_SQL}, d AS (SELECT DISTINCT score FROM scored)
    SELECT d.score, round((SELECT count(*) FROM scored s WHERE s.score > d.score AND label = 1) / (SELECT count(*) FROM scored WHERE label = 1), 6) AS tpr,
      round((SELECT count(*) FROM scored s WHERE s.score > d.score AND label = 0) / (SELECT count(*) FROM scored WHERE label = 0), 6) AS fpr FROM d""",
)
def m16(spark, sf):
    out = ev.roc_curve(fx.scored(spark, sf))
    return out.select("score", F.round("tpr", 6).alias("tpr"), F.round("fpr", 6).alias("fpr"))


@query(
    "m17_auc",
    f"""WITH {fx.SCORED_SQL} SELECT round(sum(CASE WHEN p.score > n.score THEN 1.0::DOUBLE WHEN p.score = n.score THEN 0.5 ELSE 0 END) / count(*), 6) AS auc
    FROM scored p JOIN scored n ON p.label = 1 AND n.label = 0""",
)
def m17(spark, sf):
    return ev.auc(fx.scored(spark, sf)).withColumn("auc", F.round("auc", 6))


@query(
    "m18_best_threshold",
    f"""WITH {fx.SCORED_SQL}, d AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) AS n FROM scored GROUP BY 1),
    b AS (SELECT score AS threshold, coalesce(sum(-1.0::DOUBLE * n + 0.013::DOUBLE * 100 * p) OVER
      (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS balance FROM d)
    SELECT threshold, round(balance, 6) AS balance FROM b ORDER BY round(balance, 6) DESC, threshold LIMIT 1""",
)
def m18(spark, sf):
    return ev.best_threshold(fx.scored(spark, sf), 1.0, 0.013).withColumn("balance", F.round("balance", 6))


@query(
    "m20_group_fairness",
    f"""WITH {fx.SCORED_SQL} SELECT grp, count(*) AS n, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS outcome_rate,
      round(avg((score > 800)::INT), 6) AS called_rate, round(avg((score > 800)::INT) FILTER (label = 0), 6) AS false_positive_rate,
      round(avg((score <= 800)::INT) FILTER (label = 1), 6) AS false_negative_rate FROM scored GROUP BY 1""",
)
def m20(spark, sf):
    out = ev.group_fairness(fx.scored(spark, sf), "grp", 800)
    return out.select("grp", "n", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


# --- linear algebra -------------------------------------------------------------------------


@query(
    "m05_linear_regression",
    """SELECT round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope FROM lineitem""",
)
def m05(spark, sf):
    intercept, slope = linalg.gram_solve(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")
    return spark.createDataFrame([(round(intercept, 4), round(slope, 4))], "intercept double, slope double")


@query("m24_pca")
def m24(spark, sf):
    rows = fx.vectors(spark, sf).select("id", array_to_vector("vec").alias("features"))
    _, projected = linalg.pca(rows, "features", 3)
    return projected.select("id", F.posexplode(vector_to_array("projection")).alias("pc", "value"))


@query("m25_low_rank")
def m25(spark, sf):
    near, stats = linalg.low_rank(fx.vectors(spark, sf).select("id", "vec"), 5)
    return near.select("id", F.posexplode("vec").alias("j", "value")).withColumn("error", stats.select("error").scalar())


@query(
    "m25_sketched_values",
    f"""WITH {fx.ENTRIES_SQL}, gram AS (SELECT a.dim AS i, b.dim AS j, sum(a.value * b.value) AS g FROM entries a JOIN entries b USING (id) GROUP BY 1, 2)
    SELECT (SELECT count(DISTINCT dim) FROM entries) AS n, round(sum(g) FILTER (i = j), 6) AS squares, round(sum(g * g), 6) AS fourths, 0.0::DOUBLE AS residual FROM gram""",
)
def m25_sketch(spark, sf):
    """All singular values from a narrow sketch: their power sums, and how far A'A v is from its multiple of v."""
    entries = fx.entries(spark, sf).select(F.col("id").alias("i"), F.col("dim").alias("k"), F.col("value").alias("a"))
    values, vectors = singular_vectors(entries, 64, oversample=-40)
    turned = entries.select(F.col("k").alias("i"), F.col("i").alias("k"), "a")
    twice = times(turned, times(entries, vectors)).withColumnRenamed("vec", "twice")
    scale = F.array(*(F.lit(float(v * v)) for v in values))
    gap = F.array_max(F.zip_with("twice", F.zip_with("vec", scale, lambda x, e: x * e), lambda a, b: F.abs(a - b)))
    worst = vectors.join(twice, "k").agg(F.max(gap).alias("residual"))
    return worst.select(
        F.lit(len(values)).cast("long").alias("n"), F.lit(round(float((values**2).sum()), 6)).alias("squares"),
        F.lit(round(float((values**4).sum()), 6)).alias("fourths"), (F.round("residual", 6) + 0.0).alias("residual"),
    )


COV_SQL = f"""WITH {fx.POINTS_SQL}, s AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM points),
    e AS (SELECT (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS big, (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b) AS small FROM s)"""


@query(
    "m24_pca_plane",
    f"{COV_SQL} SELECT 0 AS pc, round(big, 9) AS variance FROM e UNION ALL SELECT 1, round(small, 9) FROM e",
)
def m24_plane(spark, sf):
    points = fx.points(spark, sf).select("id", array_to_vector(F.array("x", "y")).alias("features"))
    _, projected = linalg.pca(points, "features", 2)
    long = projected.select(F.posexplode(vector_to_array("projection")).alias("pc", "value"))
    return long.groupBy("pc").agg(F.round(F.var_samp("value"), 9).alias("variance"))


@query("m25_low_rank_energy", f"WITH {fx.ENTRIES_SQL} SELECT id, round(sum(value * value), 6) AS energy FROM entries GROUP BY 1")
def m25_energy(spark, sf):
    """Row by row, the squares of the approximation and of what it misses add up to the row's own."""
    rows = fx.vectors(spark, sf).select("id", "vec")
    near, _ = linalg.low_rank(rows, 5)

    def square(col):
        return F.aggregate(col, F.lit(0.0), lambda a, v: a + v * v)

    both = rows.join(near.withColumnRenamed("vec", "near"), "id")
    missed = F.zip_with("vec", "near", lambda a, b: a - b)
    return both.select("id", F.round(square(F.col("near")) + square(missed), 6).alias("energy"))


@query(
    "m25_low_rank_plane",
    f"""WITH {fx.POINTS_SQL}, s AS (SELECT sum(x * x) AS a, sum(x * y) AS b, sum(y * y) AS c, count(*) AS n FROM points),
    e AS (SELECT (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b) AS small, a + c AS total, n FROM s)
    SELECT 1 AS rank, round((n + 3) / (n * 2), 6) AS ratio, round(sqrt(small / total), 6) AS error FROM e""",
)
def m25_plane(spark, sf):
    _, stats = linalg.low_rank(fx.points(spark, sf).select("id", F.array("x", "y").alias("vec")), 1)
    return stats.select("rank", F.round("ratio", 6).alias("ratio"), F.round("error", 6).alias("error"))


def _pagerank_sql(rounds: int) -> str:
    steps = [f"""WITH {fx.EDGES_SQL}, d AS (SELECT src, count(*) AS deg FROM edges GROUP BY 1),
    v AS (SELECT DISTINCT node FROM (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges)), c AS (SELECT count(*)::DOUBLE AS n FROM v),
    r0 AS MATERIALIZED (SELECT node, 1 / n AS rank FROM v, c)"""]
    for i in range(rounds):
        steps.append(f"""r{i + 1} AS MATERIALIZED (SELECT v.node, (0.15::DOUBLE + 0.85::DOUBLE * (SELECT coalesce(sum(rank), 0) FROM r{i}
        WHERE node NOT IN (SELECT src FROM d))) / n + 0.85::DOUBLE * coalesce(g.s, 0) AS rank FROM v CROSS JOIN c LEFT JOIN
        (SELECT dst, sum(rank / deg) AS s FROM edges JOIN d USING (src) JOIN r{i} ON r{i}.node = src GROUP BY 1) g ON g.dst = v.node)""")
    return ", ".join(steps) + f" SELECT node, round(rank, 9) AS rank FROM r{rounds}"


@query("m37_pagerank", _pagerank_sql(8))
def m37(spark, sf):
    return linalg.pagerank(fx.edges(spark, sf), max_iter=8, tol=0.0).withColumn("rank", F.round("rank", 9))


def matrix(spark, sf):
    return fx.entries(spark, sf).select(F.col("id").alias("i"), F.col("dim").cast("long").alias("j"), "value")


@query(
    "m38_sparse_matvec",
    f"""WITH {fx.ENTRIES_SQL}, x AS (SELECT dim, sum(value) AS x FROM entries GROUP BY 1), y AS (SELECT id, count(*) % 7 + id % 5 AS x FROM entries GROUP BY 1)
    SELECT 'row' AS kind, id AS at, round(sum(value * x), 6) + 0.0 AS value FROM entries JOIN x USING (dim) GROUP BY 2
    UNION ALL SELECT 'col', dim, round(sum(value * x), 6) + 0.0 FROM entries JOIN y USING (id) GROUP BY 2""",
)
def m38(spark, sf):
    a = matrix(spark, sf)
    x = a.groupBy("j").agg(F.sum("value").alias("x"))
    y = a.groupBy("i").agg((F.count(F.lit(1)) % 7 + F.max(F.col("i") % 5)).alias("x"))
    rows = linalg.spmv(a, x).select(F.lit("row").alias("kind"), F.col("i").alias("at"), "value")
    cols = linalg.spmv_t(a, y).select(F.lit("col").alias("kind"), F.col("j").alias("at"), "value")
    return rows.unionByName(cols).withColumn("value", F.round("value", 6) + 0.0)


@query(
    "m39_matrix_product",
    f"""WITH {fx.ENTRIES_SQL} SELECT a.dim AS i, b.dim AS j, round(sum(a.value * b.value), 6) + 0.0 AS value
    FROM entries a JOIN entries b USING (id) GROUP BY 1, 2""",
)
def m39(spark, sf):
    a = matrix(spark, sf)
    turned = a.select(F.col("j").alias("i"), F.col("i").alias("j"), "value")
    return linalg.matmul(turned, a).withColumn("value", F.round("value", 6) + 0.0)


T1, T2 = 0.8504, 0.2416


@query(
    "m40_kalman_ma2",
    f"""WITH RECURSIVE {fx.SERIES_SQL}, c AS (SELECT series, t, value - avg(value) OVER (PARTITION BY series) AS x, avg(value) OVER (PARTITION BY series) AS mu FROM series),
    k AS (SELECT series, t, 0.0::DOUBLE AS f, x AS e, 0.0::DOUBLE AS e_old, mu,
        {T1}::DOUBLE / (1e7::DOUBLE + 1) AS k1, {T2}::DOUBLE / (1e7::DOUBLE + 1) AS k2, 0.0::DOUBLE AS k2_old, 1e7::DOUBLE AS p, 0.0::DOUBLE AS q, 1e7::DOUBLE AS s
      FROM c WHERE t = 1
      UNION ALL
      SELECT series, t, f, x - f, e, mu, (q + {T1}::DOUBLE) / (p + 1), {T2}::DOUBLE / (p + 1), k2, p, q, s FROM (
        SELECT c.series, c.t, c.x, c.mu, k.e, k.k1 * k.e + k.k2_old * k.e_old AS f, k.k2,
          k.s + {T1 * T1}::DOUBLE - k.k1 * (k.q + {T1}::DOUBLE) AS p, {T1 * T2}::DOUBLE - k.k1 * {T2}::DOUBLE AS q, {T2 * T2}::DOUBLE - k.k2 * {T2}::DOUBLE AS s
        FROM k JOIN c ON c.series = k.series AND c.t = k.t + 1))
    SELECT series, t AS at, round(f + mu, 6) AS forecast FROM k""",
)
def m40(spark, sf):
    out = linalg.kalman_ma(fx.series(spark, sf), T1, T2)
    return out.select("series", "at", F.round("forecast", 6).alias("forecast"))


# --- clustering -----------------------------------------------------------------------------

C3 = ((-0.1, -0.1), (0.0, 0.1), (0.1, 0.0))
CENTRES_SQL = "centres(k, cx, cy) AS (VALUES " + ", ".join(f"({i}, {x}::DOUBLE, {y}::DOUBLE)" for i, (x, y) in enumerate(C3)) + ")"


@query("m27_kmeans")
def m27(spark, sf):
    assigned, _, _ = cluster.kmeans(fx.points(spark, sf), ["x", "y"], 4, standardise=True)
    return assigned.select("id", "cluster")


@query("m27_kmeans_nearest", f"WITH {fx.POINTS_SQL} SELECT id, true AS nearest FROM points")
def m27_nearest(spark, sf):
    """Every point must sit with the nearest of the fitted centres."""
    dims = ["x", "y"]
    assigned, centres, _ = cluster.kmeans(fx.points(spark, sf), dims, 4)
    again = cluster.nearest_centre(assigned.withColumnRenamed("cluster", "given"), dims, centres)
    return again.select("id", (F.col("cluster") == F.col("given")).alias("nearest"))


@query(
    "m28_kmeans_step",
    f"""WITH {fx.POINTS_SQL}, {CENTRES_SQL}, d AS (SELECT id, x, y, k, row_number() OVER (PARTITION BY id ORDER BY (x - cx) * (x - cx) + (y - cy) * (y - cy), k) AS rn
      FROM points CROSS JOIN centres) SELECT k AS cluster, count(*) AS n, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM d WHERE rn = 1 GROUP BY 1""",
)
def m28(spark, sf):
    out = cluster.kmeans_step(fx.points(spark, sf), ["x", "y"], C3)
    return out.select("cluster", "n", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("m29_elbow")
def m29(spark, sf):
    return cluster.elbow(fx.points(spark, sf), ["x", "y"])


@query(
    "m30_soft_kmeans_step",
    f"""WITH {fx.POINTS_SQL}, {CENTRES_SQL}, a AS (SELECT x, y FROM points UNION ALL SELECT cx, cy FROM centres),
    s AS (SELECT var_samp(x) AS vx, var_samp(y) AS vy FROM a),
    w AS (SELECT id, x, y, k, exp(-2 * sqrt((x - cx) * (x - cx) / vx + (y - cy) * (y - cy) / vy)) AS w FROM points CROSS JOIN centres CROSS JOIN s),
    r AS (SELECT *, w / (sum(w) OVER (PARTITION BY id) + 1e-16::DOUBLE) AS r FROM w)
    SELECT k AS cluster, round(sum(x * r) / sum(r), 6) AS x, round(sum(y * r) / sum(r), 6) AS y FROM r GROUP BY 1""",
)
def m30(spark, sf):
    centres = cluster.soft_kmeans_step(fx.points(spark, sf), ["x", "y"], C3, 2.0)
    rows = [(i, round(x, 6), round(y, 6)) for i, (x, y) in enumerate(centres)]
    return spark.createDataFrame(rows, "cluster int, x double, y double")


def _mixture_sql(rounds: int) -> str:
    density = "ln(w) - 0.5 * ((x - mx) * (x - mx) / vx + ln(2 * pi() * vx) + (y - my) * (y - my) / vy + ln(2 * pi() * vy))"
    steps = [f"""WITH {fx.POINTS_SQL}, {CENTRES_SQL}, v AS (SELECT var_pop(x) AS vx, var_pop(y) AS vy FROM points),
    t0 AS MATERIALIZED (SELECT k, 1 / 3::DOUBLE AS w, cx AS mx, cy AS my, vx, vy FROM centres, v)"""]
    for i in range(rounds):
        steps.append(f"""l{i} AS MATERIALIZED (SELECT id, x, y, k, exp({density}) AS d FROM points CROSS JOIN t{i}),
        r{i} AS MATERIALIZED (SELECT *, d / sum(d) OVER (PARTITION BY id) AS r FROM l{i}),
        c{i} AS MATERIALIZED (SELECT k, sum(r) / (SELECT count(*) FROM points) AS w, sum(r * x) / sum(r) AS mx, sum(r * y) / sum(r) AS my FROM r{i} GROUP BY k),
        t{i + 1} AS MATERIALIZED (SELECT k, max(w) AS w, max(mx) AS mx, max(my) AS my, greatest(sum(r * (x - mx) * (x - mx)) / sum(r), 1e-6::DOUBLE) AS vx,
          greatest(sum(r * (y - my) * (y - my)) / sum(r), 1e-6::DOUBLE) AS vy FROM r{i} JOIN c{i} USING (k) GROUP BY k)""")
    shown = ", ".join(f"round({a}, 6) + 0.0 AS {b}" for a, b in (("w", "weight"), ("mx", "x"), ("my", "y"), ("vx", "var_x"), ("vy", "var_y")))
    return ", ".join(steps) + f" SELECT k AS component, {shown} FROM t{rounds}"


@query("m31_gaussian_mixture", _mixture_sql(3))
def m31(spark, sf):
    weights, means, variances, _ = cluster.gmm(fx.points(spark, sf), ["x", "y"], C3, 3)
    rows = [
        (i, *[round(v, 6) + 0.0 for v in (weights[i], *means[i], *variances[i])]) for i in range(len(weights))
    ]
    return spark.createDataFrame(rows, "component int, weight double, x double, y double, var_x double, var_y double")


NEAR_SQL = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"


@query(
    "j09_eps_neighbours",
    f"WITH {fx.POINTS_SQL} SELECT a.id, count(*) FILTER ({NEAR_SQL} < 0.05::DOUBLE) AS n FROM points a CROSS JOIN points b GROUP BY 1",
)
def j09(spark, sf):
    return cluster.eps_counts(fx.points(spark, sf), ["x", "y"], 0.05)


@query(
    "m32_core_points",
    f"WITH {fx.POINTS_SQL} SELECT a.id, count(*) FILTER ({NEAR_SQL} < 0.05::DOUBLE) >= 10 AS core FROM points a CROSS JOIN points b GROUP BY 1",
)
def m32(spark, sf):
    return cluster.core_points(fx.points(spark, sf), ["x", "y"], 0.05, 10, strict=True).select("id", "core")


@query(
    "m33_k_distance",
    f"""WITH {fx.POINTS_SQL}, d AS (SELECT a.id, {NEAR_SQL} AS distance, row_number() OVER (PARTITION BY a.id ORDER BY {NEAR_SQL}, b.id) AS rn
      FROM points a JOIN points b ON a.id <> b.id) SELECT id, round(distance, 6) AS distance FROM d WHERE rn = 4""",
)
def m33(spark, sf):
    return cluster.k_distance(fx.points(spark, sf), ["x", "y"], 4).withColumn("distance", F.round("distance", 6))


@query(
    "m34_dbscan",
    f"""WITH RECURSIVE {fx.POINTS_SQL}, p AS (SELECT a.id AS a, b.id AS b FROM points a CROSS JOIN points b WHERE {NEAR_SQL} <= 0.03::DOUBLE),
    core AS (SELECT a AS id FROM p GROUP BY 1 HAVING count(*) >= 5),
    e AS (SELECT a, b FROM p WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach AS (SELECT id, id AS r FROM core UNION SELECT reach.id, e.b FROM reach JOIN e ON reach.r = e.a),
    named AS (SELECT id, min(r) AS label FROM reach GROUP BY 1),
    edge AS (SELECT p.a AS id, min(label) AS label FROM p JOIN named ON named.id = p.b WHERE p.a NOT IN (SELECT id FROM core) GROUP BY 1)
    SELECT points.id, core.id IS NOT NULL AS core, coalesce(named.label, edge.label, -1) AS label FROM points
    LEFT JOIN core ON core.id = points.id LEFT JOIN named ON named.id = points.id LEFT JOIN edge ON edge.id = points.id""",
)
def m34(spark, sf):
    return cluster.dbscan(fx.points(spark, sf), ["x", "y"], 0.03, 5)


@query("m35_spectral")
def m35(spark, sf):
    edges = fx.edges(spark, sf)
    pairs = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return cluster.spectral(pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("w")), 3, 10, "w")


def _walks(spark, sf):
    """Users of events that follow each other, with the number of directions as weight."""
    return fx.edges(spark, sf).select("src", "dst", F.lit(1.0).alias("weight"))


@query(
    "m35_laplacian_first",
    f"""WITH {fx.EDGES_SQL}, ends AS (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges), d AS (SELECT id, count(*) AS n FROM ends GROUP BY 1)
    SELECT id, round(sqrt(n / (SELECT sum(n) FROM d)), 6) AS weight FROM d""",
)
def m35_first(spark, sf):
    """The first vector of a connected graph is the root of each node's share of all link ends."""
    _, _, vectors = laplacian_vectors(_walks(spark, sf), 1)
    return vectors.select("id", F.round(F.abs(F.col("vec")[0]), 6).alias("weight"))


@query(
    "m35_laplacian_residuals",
    """SELECT i AS component, i = 1 AS is_zero, true AS ascends, true AS settled, true AS unit
    FROM (SELECT unnest([1, 2, 3, 4]) AS i)""",
)
def m35_residuals(spark, sf):
    """``L v - e v`` and the length of each of four vectors, measured over the links, apart from the solver."""
    values, _, vectors = laplacian_vectors(_walks(spark, sf), 4)
    entries = vectors.select("id", F.posexplode("vec").alias("c", "x"))
    walk = half_walk(_walks(spark, sf))
    moved = walk.join(entries.select(F.col("id").alias("k"), "c", "x"), "k").groupBy(F.col("i").alias("id"), "c").agg(F.sum(F.col("a") * F.col("x")).alias("y"))
    known = spark.createDataFrame([(c, float(e), c == 0 or bool(e >= values[c - 1])) for c, e in enumerate(values)], "c int, e double, ascends boolean")
    both = entries.join(moved, ["id", "c"]).join(F.broadcast(known), "c").groupBy("c", "e", "ascends")
    # L v = 2 v - 2 A v for the matrix A that the solver multiplies by.
    rest = 2 * F.col("x") - 2 * F.col("y") - F.col("e") * F.col("x")
    sums = both.agg(F.sqrt(F.sum(rest * rest)).alias("rest"), F.sum(F.col("x") * F.col("x")).alias("square"))
    return sums.select(
        (F.col("c") + 1).alias("component"), (F.abs("e") < 1e-9).alias("is_zero"), "ascends",
        (F.col("rest") < 1e-6).alias("settled"), (F.abs(F.col("square") - 1) < 1e-9).alias("unit"),
    )


@query("m35_spectral_clusters")
def m35_clusters(spark, sf):
    return cluster.spectral_clusters(_walks(spark, sf), 3)


@query(
    "m36_gaussian_score",
    f"""WITH {fx.POINTS_SQL}, s AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, x) AS a, covar_pop(x, y) AS b, covar_pop(y, y) AS c FROM points)
    SELECT id, round(-0.5 * ((x - mx) * (x - mx) * c - 2 * (x - mx) * (y - my) * b + (y - my) * (y - my) * a) / (a * c - b * b), 6) + 0.0 AS score FROM points, s""",
)
def m36(spark, sf):
    out = cluster.gaussian_score(fx.points(spark, sf), ["x", "y"])
    return out.select("id", (F.round("score", 6) + 0.0).alias("score"))
