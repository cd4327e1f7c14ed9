"""Sketched singular vectors: against numpy, for any rank, and orthonormal bases by merged triangles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.plans import sketch


def triplets(spark, a):
    i, k = np.nonzero(a)
    return spark.createDataFrame([(int(x), f"c{y}", float(a[x, y])) for x, y in zip(i, k, strict=True)], "i long, k string, a double")


def dense(rows, m):
    found = {r.k: r.vec for r in rows.collect()}
    width = len(next(iter(found.values())))
    return np.array([found.get(f"c{j}", [0.0] * width) for j in range(m)])


@pytest.mark.parametrize("rank, k", [(60, 5), (3, 8), (1, 1)])
def test_against_numpy(spark, rank, k):
    rng = np.random.default_rng(rank)
    a = rng.standard_normal((300, rank)) @ np.diag(0.9 ** np.arange(rank)) @ rng.standard_normal((rank, 70))
    if rank == 60:  # a sparse one
        a[rng.random(a.shape) < 0.2] = 0
    exact = np.linalg.svd(a)[1]
    known = min(k, int((exact > 1e-9 * exact[0]).sum()))
    values, rows = sketch.singular_vectors(triplets(spark, a), k, oversample=6)
    v = dense(rows, 70)
    assert np.allclose(values[:known], exact[:known], rtol=1e-6)
    assert np.allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-10)
    best = np.sqrt((exact[known:] ** 2).sum())
    assert np.linalg.norm(a - a @ v[:, :known] @ v[:, :known].T) <= best + 1e-6 * exact[0]


def test_tall_triangle_and_basis(spark):
    rng = np.random.default_rng(1)
    a = rng.standard_normal((500, 4))
    a = np.hstack([a, a[:, :1] + a[:, 1:2]])  # a dependent column
    df = spark.createDataFrame([(f"c{i}", r.tolist()) for i, r in enumerate(a)], "k string, vec array<double>").repartition(23)
    r = sketch.tall_r(df, fan=3)  # three levels of merging
    assert np.allclose(r.T @ r, a.T @ a)
    q = dense(sketch.orthonormal(df), 500)
    assert q.shape == (500, 4) and np.allclose(q.T @ q, np.eye(4), atol=1e-13)
    assert np.allclose(q @ (q.T @ a), a)


def test_no_entries(spark):
    values, rows = sketch.singular_vectors(spark.createDataFrame([], "i long, k string, a double"), 3)
    assert len(values) == 0 and rows.count() == 0
    values, rows = sketch.singular_vectors(spark.range(5).select(F.col("id").alias("i"), F.lit("x").alias("k"), F.lit(0.0).alias("a")), 3)
    assert len(values) == 0


@pytest.mark.parametrize("at_once, entries", [(1 << 22, 1 << 21), (12, 1 << 21), (1 << 22, 9)])
def test_products_in_blocks(spark, monkeypatch, at_once, entries):
    """Whole vectors move, one for a row and block, whatever the sizes of the blocks; a null column meets nothing."""
    monkeypatch.setattr(sketch, "AT_ONCE", at_once)
    monkeypatch.setattr(sketch, "ENTRIES", entries)
    rng = np.random.default_rng(3)
    a, b = np.where(rng.random((9, 30)) < 0.4, rng.standard_normal((9, 30)), 0), rng.standard_normal((30, 4))
    rows = spark.createDataFrame([(f"c{i}", r.tolist()) for i, r in enumerate(b)] + [(None, [9.0] * 4)], "k string, vec array<double>")
    long = triplets(spark, a)
    odd = long.unionByName(spark.createDataFrame([(0, None, 1.0), (0, "unknown", 1.0)], "i long, k string, a double"))
    found = {r["k"]: r["vec"] for r in sketch.times(sketch.Factor(odd), rows).collect()}
    assert np.allclose([found[i] for i in range(9)], a @ b) and len(found) == 9


@pytest.mark.parametrize("at_once", [1 << 22, 64])
def test_asked_products(spark, monkeypatch, at_once):
    """Pairs asked twice, rows without entries, unknown columns and nulls; in one block, and in slices of columns."""
    monkeypatch.setattr(sketch, "AT_ONCE", at_once)
    rng = np.random.default_rng(3)
    a, v = np.where(rng.random((12, 9)) < 0.5, rng.standard_normal((12, 9)), 0.0), rng.standard_normal((9, 20))
    a[5] = 0
    entries = spark.createDataFrame([(int(i), int(k), float(a[i, k])) for i, k in zip(*np.nonzero(a), strict=True)], "i long, k long, a double")
    vectors = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(v)], "k long, vec array<double>")
    pairs = [(i, j) for i in range(14) for j in range(11)]
    asked = spark.createDataFrame([*pairs, (1, 1), (None, 2), (2, None)], "i long, j long")
    found = sketch.asked_products(entries, vectors, asked, 20).collect()
    exact = a @ v @ v.T
    assert sorted((r.i, r.j) for r in found) == [(i, j) for i, j in pairs if i < 12 and i != 5 and j < 9]
    assert all(abs(r.dot - exact[r.i, r.j]) < 1e-9 for r in found)


def test_factors_of_users_are_not_unfolded(spark, monkeypatch):
    """Scores come from where a user's factors are formed: no line for each user and factor."""
    from tabloom.operators import recommend as rec

    monkeypatch.setattr(rec, "block_product", None)
    rows = [(u, i, float(1 + (u * i + u) % 5)) for u in range(20) for i in range(8) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    out = rec.svd_recommend(train, train.union(spark.createDataFrame([(99, 1, 0.0), (1, 99, 3.0)], train.schema)), 8).collect()
    assert len(out) == len(rows) + 2 and all(abs(r.score - r.rating) < 1e-9 for r in out if r.user_id != 99)
