"""Whitening: components, exact deviations and errors against dense decompositions, repeated values, odd rows."""

import math

import numpy as np
import pytest

from tabloom.llm import whitening
from tabloom.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>"


def dense(vectors):
    """Distinct integer rows, mean, falling variances and components, by numpy."""
    x = np.unique(np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000, axis=0)
    centred = (x - x.mean(axis=0)).astype(float)
    values, basis = np.linalg.eigh(centred.T @ centred / len(x))
    return x, values[::-1], basis[:, ::-1]


def test_query_against_numpy(spark, small):
    got = QUERIES["op13_lanczos_whitening"](spark, small)
    kinds = {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert dict(got.dtypes) == kinds
    got = got.toPandas()
    table = {r.vec_id: r.embedding for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()}
    x, values, basis = dense(list(table.values()))
    assert len(got) == 16 * len(table) and set(got.n) == {len(x)}
    sums = x.sum(axis=0)
    entries = {k: np.floor(64 * np.asarray(v, float)).astype(np.int64) + 1_000_000 for k, v in table.items()}
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    own = np.stack([entries[k] for k in wide.index]) - x.mean(axis=0)
    for c in range(1, 17):
        want = own @ basis[:, c - 1] / math.sqrt(values[c - 1])
        sign = np.sign(want @ wide[c].to_numpy())
        assert np.abs(sign * wide[c].to_numpy() - want).max() < 1e-7
        assert got[got.component == c].explained.iloc[0] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
    exact = {k: sum((len(x) * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True)) for k, v in entries.items()}
    assert all(exact[k] == d for k, d in zip(got.vec_id, got.deviation, strict=True))
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10


def test_repeated_and_vanishing_variances(spark):
    """Equal eigenvalues need fresh starts; constant and dependent dimensions give no component."""
    rows = [*np.eye(5), *-np.eye(5)]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rows)] * 3, VECTORS)
    model = whitening.fit(df)
    assert model.n == 10 and np.allclose(model.variances, 2 * 64**2 / 10) and len(model.variances) == 5 and model.identity_error < 1e-12
    rng = np.random.default_rng(1)
    a = rng.standard_normal((200, 3))
    wide = np.hstack([np.round(a * 64) / 64, np.round(a[:, :1] * 64) / 64, np.full((200, 2), 0.25)])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(wide)], VECTORS)
    model = whitening.fit(df)
    _, values, _ = dense(wide)
    assert len(model.variances) == 3 and np.allclose(model.variances, values[:3], rtol=1e-10)
    assert math.isclose(sum(model.explained), 1.0, rel_tol=1e-12)


def test_leading_components_of_wide_rows(spark):
    """The run ends before all dimensions are through once the leading components stand."""
    rng = np.random.default_rng(2)
    scale = 40 * 0.75 ** np.arange(90)
    rows = rng.standard_normal((500, 90)) * scale
    model = whitening.fit(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], VECTORS), components=4)
    _, values, basis = dense(rows)
    assert model.steps < 90 and np.allclose(model.variances, values[:4], rtol=1e-11)
    assert np.allclose(np.abs((model.basis * basis[:, :4]).sum(axis=0)), 1, atol=1e-11)


def test_odd_rows(spark):
    good = [(i, [float(i % 7), float(i % 5), 1.5]) for i in range(60)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, math.nan, 2.0]), (104, [1.0, math.inf, 2.0]), (105, [1.0])]
    df = spark.createDataFrame(good + bad + [(None, [9.0, 9.0, 9.0]), (5, [1.0, 1.0, 1.0])], VECTORS).selectExpr("*", "vec_id AS key", "'x' AS whitened", "1 AS row")
    model = whitening.fit(df)
    got = whitening.transform(df, model).collect()
    assert model.dim == 3 and sorted((r.vec_id for r in got), key=lambda v: (v is None, v or 0)) == sorted([i for i, _ in good] + [5]) + [None]
    assert whitening.fit(df.limit(0)).n == 0 and whitening.transform(df, whitening.fit(df.limit(0))).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], VECTORS)
    assert [r.whitened for r in whitening.transform(one, whitening.fit(one)).collect()] == [[], []]
    far = spark.createDataFrame([(i, [1e12 * i, float(i), -3.0]) for i in range(40)], VECTORS)  # exact where doubles of squares are not
    model = whitening.fit(far)
    x = [[math.floor(64 * v) + 1_000_000 for v in (1e12 * i, float(i), -3.0)] for i in range(40)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((40 * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for i, r in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in whitening.transform(far, model).collect()} == want
