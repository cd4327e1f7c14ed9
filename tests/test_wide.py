"""Moments, components, clusters and densities of array columns against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import cluster, wide
from tabloom.plans.moments import mean_and_covariance, outer_matrix


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(c, 0.5, size=(40, 20)) for c in (-1.0, 0.0, 2.0)]) + 100
    x[:, 7] = 5.0  # a dimension without spread
    return x


@pytest.fixture(scope="module")
def table(spark, points):
    """A third of all rows repeats one point; rows without a whole vector are among them."""
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(2000, None), (2001, [1.0, None] + [0.0] * 18)]
    return spark.createDataFrame(rows, "id long, vec array<double>").repartition(7).cache()


@pytest.fixture(scope="module")
def all_points(points):
    return np.vstack([points, np.tile(points[3], (60, 1))])


def test_moments(table, all_points):
    n, mean, cov = mean_and_covariance(table, "vec")
    assert n == 180 and mean == pytest.approx(all_points.mean(axis=0))
    assert cov == pytest.approx(np.cov(all_points.T), abs=1e-10)
    got = {(r["i"], r["j"]): r["value"] for r in wide.covariance(table, "vec", ddof=0).collect()}
    assert got == pytest.approx({(i, j): np.cov(all_points.T, ddof=0)[i, j] for i in range(20) for j in range(i, 20)}, abs=1e-10)


def test_odd_tables(spark, table):
    assert outer_matrix(table.filter("id < 0"), F.col("vec"), F.col("vec")).shape == (0, 0)
    with pytest.raises(ValueError):
        mean_and_covariance(table.filter("id = 2000"), "vec")
    ragged = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, vec array<double>")
    for parts in (1, 2):
        with pytest.raises(Exception, match="different lengths"):
            outer_matrix(ragged.repartitionByRange(parts, "id"), F.col("vec"), F.col("vec"))
    assert outer_matrix(ragged.filter("id = 2"), F.array(F.lit(2.0)), F.col("vec")).tolist() == [[2.0, 4.0]]


@pytest.mark.parametrize("corr", [False, True])
def test_pca(table, all_points, corr):
    values, vectors, projected = wide.pca(table, "vec", 5, corr)
    scaled = all_points - all_points.mean(axis=0)
    if corr:
        width = all_points.std(axis=0, ddof=1)
        width[7] = 1.0
        scaled = scaled / width
    s = np.linalg.svd(scaled, compute_uv=False)
    assert values == pytest.approx(s[:5] ** 2 / 179)
    got = {r["id"]: r["projection"] for r in projected.collect()}
    assert got[2000] is None and got[2001] is None
    assert np.array([got[i] for i in range(120)]) == pytest.approx((scaled @ vectors)[:120], abs=1e-9)


def test_kmeans(table, all_points):
    centres, sizes = wide.kmeans(table, "vec", all_points[[0, 50, 100]], rounds=30)
    far = ((all_points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    assert sizes.tolist() == np.bincount(far, minlength=3).tolist()
    assert centres == pytest.approx(np.array([all_points[far == k].mean(axis=0) for k in range(3)]))
    got = {r["id"]: r for r in wide.nearest_centre(table, "vec", centres).collect()}
    assert [got[i]["cluster"] for i in range(120)] == far[:120].tolist() and got[2000]["cluster"] is None
    assert got[5]["distance"] == pytest.approx(np.linalg.norm(all_points[5] - centres[far[5]]))
    lonely, sizes = wide.kmeans(table, "vec", [all_points[0], np.full(20, 1e6)], rounds=2)
    assert sizes.tolist() == [180, 0] and lonely[1].tolist() == [1e6] * 20


def test_same_as_by_columns(table, all_points):
    """The siblings that take one column for each dimension, over three of them."""
    dims = ["a", "b", "c"]
    three = table.filter("id < 2000").select("id", F.slice("vec", 1, 3).alias("vec"), *[F.col("vec")[i].alias(d) for i, d in enumerate(dims)])
    start = all_points[[0, 50, 100], :3].tolist()
    assert wide.soft_kmeans_step(three, "vec", start, 2.0) == pytest.approx(np.array(cluster.soft_kmeans_step(three, dims, start, 2.0)))
    ours, theirs = wide.gmm(three, "vec", start, 4), cluster.gmm(three, dims, start, 4)
    for a, b in zip(ours, theirs, strict=True):
        assert np.array(a) == pytest.approx(np.array(b), rel=1e-6)
    assert ours[3] == sorted(ours[3])  # the likelihood never falls


def test_gaussian_score(table, all_points):
    got = {r["id"]: r for r in wide.gaussian_score(table, "vec").collect()}
    gap, cov = all_points - all_points.mean(axis=0), np.cov(all_points.T, ddof=0)
    want = -0.5 * np.einsum("ni,ij,nj->n", gap, np.linalg.pinv(cov, hermitian=True), gap)
    assert [got[i]["score"] for i in range(120)] == pytest.approx(want[:120].tolist(), rel=1e-6)
    assert sum(r["score"] for r in got.values() if r["score"] is not None) == pytest.approx(-0.5 * 180 * 19)
    assert got[2000]["score"] is None and got[2001]["log_density"] is None
