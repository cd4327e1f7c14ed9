"""Clustering on tables of points: an id column and one column per dimension."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, PowerIterationClustering
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.plans import KeyedLinks, checkpointed, laplacian_vectors, nearest_neighbours, written

Centres = Sequence[Sequence[float]]

# --- centres --------------------------------------------------------------------------------


def _square_distance(dims: Sequence[str], centre: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for c, v in zip(dims, centre):
        total = total + (F.col(c) - v) * (F.col(c) - v)
    return total


def nearest_centre(df: DataFrame, dims: Sequence[str], centres: Centres) -> DataFrame:
    """Add ``cluster`` (first nearest centre) and ``distance``; centres are a short literal list."""
    best = F.array_min(F.array(*[
        F.struct(_square_distance(dims, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)
    ]))
    return df.withColumn("_best", best).select(
        *df.columns, F.col("_best.i").alias("cluster"), F.sqrt("_best.d").alias("distance")
    )


def kmeans_step(df: DataFrame, dims: Sequence[str], centres: Centres) -> DataFrame:
    """(cluster, n, dims...): the new mean of each cluster after one assignment."""
    return nearest_centre(df, dims, centres).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in dims]
    )


def kmeans(df: DataFrame, dims: Sequence[str], k: int, init: str = "k-means||", standardise: bool = False, seed: int = 1):
    """(assignments, centres in original units, within-cluster distance sum)."""
    vectors = VectorAssembler(inputCols=list(dims), outputCol="_vec").transform(df)
    column, mean, width = "_vec", np.zeros(len(dims)), np.ones(len(dims))
    if standardise:
        scaler = StandardScaler(withMean=True, withStd=True, inputCol="_vec", outputCol="_scaled").fit(vectors)
        vectors, column = scaler.transform(vectors), "_scaled"
        mean, width = scaler.mean.toArray(), scaler.std.toArray()
    model = KMeans(k=k, initMode=init, featuresCol=column, predictionCol="cluster", seed=seed).fit(vectors)
    centres = [list(map(float, c * width + mean)) for c in model.clusterCenters()]
    return model.transform(vectors).drop("_vec", "_scaled"), centres, model.summary.trainingCost


def elbow(df: DataFrame, dims: Sequence[str], ks: Sequence[int] = range(2, 10), seed: int = 1) -> DataFrame:
    """(k, total): sum of distances to the nearest centre for each k."""
    out = None
    for k in ks:
        _, centres, _ = kmeans(df, dims, k, seed=seed)
        total = nearest_centre(df, dims, centres).agg(F.lit(k).alias("k"), F.sum("distance").alias("total"))
        out = total if out is None else out.unionByName(total)
    return out


def soft_kmeans_step(df: DataFrame, dims: Sequence[str], centres: Centres, beta: float) -> list[list[float]]:
    """New centres from responsibilities ``exp(-beta d)`` scaled to sum 1 per point.

    d is the distance with each dimension divided by its sample variance over points and
    centres together. One pass for the variances, one for the weighted means.
    """
    k = len(centres)
    sums = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s_{c}") for c in dims],
        *[F.sum(F.col(c) * F.col(c)).alias(f"q_{c}") for c in dims],
    ).first()
    n = sums["n"] + k
    variance = []
    for j, c in enumerate(dims):
        s = sums[f"s_{c}"] + sum(m[j] for m in centres)
        q = sums[f"q_{c}"] + sum(m[j] * m[j] for m in centres)
        variance.append((q - s * s / n) / (n - 1))

    def weight(centre):
        total = F.lit(0.0)
        for c, v, var in zip(dims, centre, variance):
            total = total + (F.col(c) - v) * (F.col(c) - v) / var
        return F.exp(-beta * F.sqrt(total))

    weighed = df.select(*dims, *[weight(c).alias(f"_w{i}") for i, c in enumerate(centres)])
    total = sum((F.col(f"_w{i}") for i in range(k)), F.lit(1e-16))
    shares = weighed.select(*dims, *[(F.col(f"_w{i}") / total).alias(f"_r{i}") for i in range(k)])
    row = shares.agg(
        *[F.sum(f"_r{i}").alias(f"r{i}") for i in range(k)],
        *[F.sum(F.col(f"_r{i}") * F.col(c)).alias(f"m{i}_{c}") for i in range(k) for c in dims],
    ).first()
    return [[row[f"m{i}_{c}"] / (row[f"r{i}"] + 1e-16) for c in dims] for i in range(k)]


# --- mixtures -------------------------------------------------------------------------------


def gmm(df: DataFrame, dims: Sequence[str], means: Centres, iterations: int = 20, floor: float = 1e-6):
    """Diagonal Gaussian mixture by EM from given means.

    Each round is one pass that sums k x (2 dims + 1) numbers. Returns (weights, means,
    variances, log-likelihood per round).
    """
    k = len(means)
    start = df.agg(*[F.var_pop(c).alias(c) for c in dims]).first()
    weights = [1.0 / k] * k
    means = [list(map(float, m)) for m in means]
    variances = [[max(float(start[c]), floor) for c in dims] for _ in range(k)]
    history = []
    for _ in range(iterations):
        def log_density(i):
            total = F.lit(math.log(max(weights[i], 1e-300)))
            for c, m, v in zip(dims, means[i], variances[i]):
                total = total - 0.5 * ((F.col(c) - m) * (F.col(c) - m) / v + math.log(2 * math.pi * v))
            return total

        logs = df.select(*dims, *[log_density(i).alias(f"_l{i}") for i in range(k)])
        top = F.greatest(*[F.col(f"_l{i}") for i in range(k)]) if k > 1 else F.col("_l0")
        logs = logs.withColumn("_top", top)
        mass = sum((F.exp(F.col(f"_l{i}") - F.col("_top")) for i in range(k)), F.lit(0.0))
        logs = logs.withColumn("_all", F.col("_top") + F.log(mass))
        shares = logs.select(*dims, "_all", *[F.exp(F.col(f"_l{i}") - F.col("_all")).alias(f"_r{i}") for i in range(k)])
        row = shares.agg(
            F.count(F.lit(1)).alias("n"), F.sum("_all").alias("ll"),
            *[F.sum(f"_r{i}").alias(f"r{i}") for i in range(k)],
            *[F.sum(F.col(f"_r{i}") * F.col(c)).alias(f"s{i}_{c}") for i in range(k) for c in dims],
            *[F.sum(F.col(f"_r{i}") * (F.col(c) - means[i][j]) * (F.col(c) - means[i][j])).alias(f"q{i}_{c}")
              for i in range(k) for j, c in enumerate(dims)],
        ).first()
        history.append(row["ll"])
        for i in range(k):
            share = max(row[f"r{i}"], 1e-300)
            moved = [row[f"s{i}_{c}"] / share for c in dims]
            variances[i] = [
                max(row[f"q{i}_{c}"] / share - (moved[j] - means[i][j]) ** 2, floor) for j, c in enumerate(dims)
            ]
            weights[i], means[i] = row[f"r{i}"] / row["n"], moved
    return weights, means, variances, history


def gaussian_score(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Add ``score`` (minus half the squared Mahalanobis distance) and ``density``.

    Mean and population covariance come from one pass; a dims x dims matrix is inverted.
    """
    d = len(dims)
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(dims)],
        *[F.covar_pop(dims[i], dims[j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i, d)],
    ).first()
    cov = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)])
    inverse, det = np.linalg.pinv(cov), float(np.linalg.det(cov))
    gaps = [F.col(c) - row[f"m{i}"] for i, c in enumerate(dims)]
    form = sum((gaps[i] * gaps[j] * float(inverse[i, j]) for i in range(d) for j in range(d)), F.lit(0.0))
    scale = math.sqrt((2 * math.pi) ** d * det)
    return df.withColumn("score", -0.5 * form).withColumn("density", F.exp("score") / scale)


# --- density --------------------------------------------------------------------------------


def _cell(dims: Sequence[str], side: float) -> Column:
    return F.array(*[F.floor(F.col(c) / side) for c in dims])


def _shifted(cell: str, offsets: Sequence[tuple[int, ...]]) -> Column:
    return F.explode(F.array(*[
        F.array(*[F.col(cell)[i] + F.lit(o).cast("long") for i, o in enumerate(offset)]) for offset in offsets
    ]))


def _near_offsets(d: int, reach: float) -> list[tuple[int, ...]]:
    """Cell steps whose nearest corners lie within ``reach`` cell sides."""
    r = math.ceil(reach)
    steps = itertools.product(range(-r, r + 1), repeat=d)
    return [s for s in steps if sum(max(abs(x) - 1, 0) ** 2 for x in s) <= reach * reach + 1e-9]


def _within(dims: Sequence[str], eps: float, strict: bool, a: str = "_a_", b: str = "_b_") -> Column:
    total = F.lit(0.0)
    for c in dims:
        total = total + (F.col(a + c) - F.col(b + c)) * (F.col(a + c) - F.col(b + c))
    return F.sqrt(total) < eps if strict else F.sqrt(total) <= eps


def _named(df: DataFrame, dims: Sequence[str], prefix: str, *others: str) -> DataFrame:
    return df.select(*others, *[F.col(c).alias(prefix + c) for c in dims])


def eps_pairs(df: DataFrame, dims: Sequence[str], eps: float, strict: bool = True) -> DataFrame:
    """(a, b): pairs of ids a < b closer than eps, by an equi-join on cells of side eps.

    The answer holds every close pair; use ``eps_counts`` when only their number matters.
    """
    celled = df.withColumn("_cell", _cell(dims, eps))
    left = _named(celled, dims, "_a_", "id", "_cell").withColumnRenamed("id", "a")
    left = left.withColumn("_cell", _shifted("_cell", _near_offsets(len(dims), 1.0)))
    right = _named(celled, dims, "_b_", "id", "_cell").withColumnRenamed("id", "b")
    return left.join(right, "_cell").filter((F.col("a") < F.col("b")) & _within(dims, eps, strict)).select("a", "b")


def eps_counts(
    df: DataFrame, dims: Sequence[str], eps: float, strict: bool = True, block_rows: int = 4096
) -> DataFrame:
    """(id, n): how many points lie within eps of each point, itself included.

    Cells are cut into blocks of about ``block_rows`` points, and a task counts one block against
    another, so a crowded spot is neither one task nor a list of pairs.
    """
    celled = df.select("id", *dims, _cell(dims, eps).alias("_cell"))
    sizes = celled.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_blocks"))
    celled = written(celled.join(sizes, "_cell"), "cells")
    # Askers and answers of a cell are dealt to blocks alike, so neither side of a task grows with the crowd.
    block = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col("_blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    left = _named(celled, dims, "_a_", "id", "_cell").withColumn("_cell", _shifted("_cell", _near_offsets(len(dims), 1.0)))
    asks = left.join(celled.select("_cell", "_blocks").distinct(), "_cell").withColumn("_part", block(3)).withColumn("_block", every)
    answers = celled.select("_cell", *dims, "_blocks", block(5).alias("_block")).withColumn("_part", every)

    def count(key, points: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros(len(points), dtype=np.int64)
        a = points[["_a_" + c for c in dims]].to_numpy(dtype=float)
        b = others[list(dims)].to_numpy(dtype=float)
        step = max(1, (1 << 18) // max(1, len(b)))
        for at in range(0, len(a), step):
            square = np.zeros((len(a[at : at + step]), len(b)))
            for i in range(len(dims)):
                gap = a[at : at + step, i, None] - b[None, :, i]
                gap *= gap
                square += gap
            distance = np.sqrt(square, out=square)
            found[at : at + step] = np.count_nonzero((distance < eps) if strict else (distance <= eps), axis=1)
        return pd.DataFrame({"id": points["id"], "n": found})

    # The rows are few and their pairs many, so partitions that look small by bytes must not be put together.
    key = ["_cell_key", "_block", "_part"]
    text = F.array_join("_cell", ",").alias("_cell_key")
    tasks = df.sparkSession.sparkContext.defaultParallelism * 8
    left, right = (side.select("*", text).repartition(tasks, *key).groupBy(*key) for side in (asks, answers))
    return left.cogroup(right).applyInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def core_points(df: DataFrame, dims: Sequence[str], eps: float, min_pts: int, strict: bool = False) -> DataFrame:
    """``(id, dims, _cell, core)``: whether at least ``min_pts`` points (itself included) lie within eps.

    Cells have side eps / sqrt(dims), so all points of a cell are within eps of each other. A
    cell with ``min_pts`` points is core without any comparison; only the points of thinner
    cells, fewer than ``min_pts`` each, are compared with their surroundings.
    """
    d = len(dims)
    side = eps / math.sqrt(d)
    celled = df.select("id", *dims, _cell(dims, side).alias("_cell"))
    sizes = celled.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
    celled = written(celled.join(sizes, "_cell"), "cells")
    others = [o for o in _near_offsets(d, math.sqrt(d)) if any(o)]
    thin = _named(celled.filter(F.col("_size") < min_pts), dims, "_a_", "id", "_size", "_cell")
    asks = thin.withColumn("_cell", _shifted("_cell", others))
    met = asks.join(_named(celled, dims, "_b_", "_cell"), "_cell").groupBy("id", "_size").agg(
        F.count_if(_within(dims, eps, strict)).alias("_near")
    )
    promoted = met.filter(F.col("_size") + F.col("_near") >= min_pts).select("id", F.lit(True).alias("_up"))
    return celled.join(promoted, "id", "left").select(
        "id", *dims, "_cell", ((F.col("_size") >= min_pts) | F.coalesce("_up", F.lit(False))).alias("core")
    )


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component.

    Every round takes the smallest label among a node and its neighbours and then jumps to
    that label's own label, which shortens long chains by half; rounds end in checkpoints.
    """
    turned = F.array(*[F.struct(F.col(x).alias("v"), F.col(y).alias("w")) for x, y in (("a", "b"), ("b", "a"))])
    links = KeyedLinks(edges.select(F.explode(turned).alias("e")).select("e.v", "e.w"), "v")
    labels = checkpointed(nodes.select("node", F.col("node").alias("label")))
    while True:
        offered = links.send(labels.select(F.col("node").alias("v"), "label")).groupBy(F.col("w").alias("node")).agg(
            F.min("label").alias("_offer")
        )
        lower = labels.join(offered, "node", "left").select(
            "node", F.col("label").alias("_old"), F.least("label", F.coalesce("_offer", "label")).alias("label")
        )
        heads = labels.select(F.col("node").alias("label"), F.col("label").alias("_jump"))
        new = checkpointed(lower.join(heads, "label").select("node", "_old", F.least("label", "_jump").alias("label")))
        settled = new.filter(F.col("label") != F.col("_old")).isEmpty()
        labels = new.select("node", "label")
        if settled:
            links.close()
            return labels


def dbscan(df: DataFrame, dims: Sequence[str], eps: float, min_pts: int) -> DataFrame:
    """(id, core, label): density clusters named by their smallest core id, -1 for noise.

    Work goes over cells, not point pairs. The core points of a cell are one cluster; two cells
    join when a point of one finds a point of the other within eps (a semi-join that stops at
    the first). Border points come from thin cells only and take the smallest label in reach.
    """
    d = len(dims)
    side = eps / math.sqrt(d)
    points = written(core_points(df, dims, eps, min_pts), "dbscan-points")
    core = points.filter("core")
    units = written(core.groupBy("_cell").agg(
        F.min("id").alias("node"), *[F.min(c).alias(f"_lo_{c}") for c in dims], *[F.max(c).alias(f"_hi_{c}") for c in dims]
    ), "dbscan-units")
    half = [o for o in _near_offsets(d, math.sqrt(d)) if o > (0,) * d]
    here = units.select(
        F.col("node").alias("a"), F.col("_cell").alias("_own"), *[F.col(f"_{e}_{c}").alias(f"_a{e}_{c}") for e in ("lo", "hi") for c in dims],
        _shifted("_cell", half).alias("_cell"),
    )
    there = units.select("_cell", F.col("node").alias("b"), *[F.col(f"_{e}_{c}").alias(f"_b{e}_{c}") for e in ("lo", "hi") for c in dims])
    zero = F.lit(0.0)
    apart, across = zero, zero
    for c in dims:
        gap = F.greatest(F.col(f"_blo_{c}") - F.col(f"_ahi_{c}"), F.col(f"_alo_{c}") - F.col(f"_bhi_{c}"), zero)
        span = F.greatest(F.col(f"_bhi_{c}") - F.col(f"_alo_{c}"), F.col(f"_ahi_{c}") - F.col(f"_blo_{c}"))
        apart, across = apart + gap * gap, across + span * span
    slack = eps * 1e-9
    pairs = written(here.join(there, "_cell").filter(F.sqrt(apart) <= eps + slack).select(
        "a", "b", "_own", "_cell", (F.sqrt(across) <= eps - slack).alias("_sure"),
        *[F.col(f"_b{e}_{c}") for e in ("lo", "hi") for c in dims],
    ), "dbscan-pairs")
    # Undecided pairs: the points of one cell near the other's box look for one partner.
    outside = zero
    for c in dims:
        gap = F.greatest(F.col(f"_blo_{c}") - F.col(f"_a_{c}"), F.col(f"_a_{c}") - F.col(f"_bhi_{c}"), zero)
        outside = outside + gap * gap
    own = _named(core, dims, "_a_", "_cell").withColumnRenamed("_cell", "_own")
    asks = pairs.filter("NOT _sure").join(own, "_own").filter(F.sqrt(outside) <= eps + slack)
    target = _named(core, dims, "_b_", "_cell").withColumnRenamed("_cell", "_target")
    met = asks.join(target, (F.col("_cell") == F.col("_target")) & _within(dims, eps, False), "left_semi")
    links = pairs.filter("_sure").select("a", "b").unionByName(met.select("a", "b")).distinct()
    labels = connected_components(units.select("node"), links)

    named = units.select("_cell", "node").join(labels, "node").select("_cell", "label")
    core_labels = core.join(named, "_cell").select("id", "_cell", *dims, "label")
    border = points.filter("NOT core")
    asks = _named(border, dims, "_a_", "id", "_cell").withColumn("_cell", _shifted("_cell", _near_offsets(d, math.sqrt(d))))
    reached = asks.join(_named(core_labels, dims, "_b_", "_cell", "label"), "_cell").filter(_within(dims, eps, False))
    edge_labels = reached.groupBy("id").agg(F.min("label").alias("label"))
    edge = border.select("id").join(edge_labels, "id", "left")
    return core_labels.select("id", F.lit(True).alias("core"), "label").unionByName(
        edge.select("id", F.lit(False).alias("core"), F.coalesce("label", F.lit(-1).cast("long")).alias("label"))
    )


def k_distance(df: DataFrame, dims: Sequence[str], k: int) -> DataFrame:
    """(id, distance): distance to the k-th nearest other point, the curve to read eps from."""
    vectors = df.select("id", F.array(*[F.col(c).cast("double") for c in dims]).alias("vec"))
    near = nearest_neighbours(vectors, vectors, k, skip_self=True)
    return near.filter(F.col("rank") == k).select(F.col("query").alias("id"), "distance")


def spectral(affinities: DataFrame, k: int, iterations: int = 20, weight: str | None = None) -> DataFrame:
    """(id, cluster): power iteration clustering on (src, dst, weight)."""
    model = PowerIterationClustering(k=k, maxIter=iterations, initMode="degree", srcCol="src", dstCol="dst", weightCol=weight)
    return model.assignClusters(affinities)


def spectral_embedding(links: DataFrame, k: int, tol: float = 1e-8) -> DataFrame:
    """(id, x0, x1, ...): each node's entries in the k smallest eigenvectors of the normalised Laplacian.

    ``links`` are (src, dst, weight), taken both ways. The rows have length 1, so the clusters lie on a sphere.
    """
    values, _, vectors = laplacian_vectors(links, k, tol=tol)
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x))
    unit = lambda i: F.when(length > 0, F.col("vec")[i] / length).otherwise(0.0)
    return vectors.select("id", *[unit(i).alias(f"x{i}") for i in range(len(values))])


def spectral_clusters(links: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """(id, cluster): k-means on the Laplacian's k smallest eigenvectors. Nodes without a link are in no cluster."""
    points = spectral_embedding(links, k)
    if len(points.columns) == 1:
        return points.select("id", F.lit(0).alias("cluster"))
    return kmeans(points, points.columns[1:], k, seed=seed)[0].select("id", "cluster")
