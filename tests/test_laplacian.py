"""Eigenvectors of the normalised Laplacian: against numpy, several components, hubs, odd links, and clusters."""

import numpy as np
import pytest

from tabloom.operators import cluster
from tabloom.plans import laplacian

LINK = "src long, dst long, weight double"


def graph(kind):
    rng = np.random.default_rng(5)
    if kind == "hub":  # one node in most links
        links = [(0, i, 1.0) for i in range(1, 90)] + [(i, i % 13 + 1, 2.0) for i in range(14, 90)]
    elif kind == "components":
        links = [(g * 50 + i, g * 50 + (i + s) % 50, 1.0) for g in range(3) for i in range(50) for s in (1, 7)]
    else:
        a, b = rng.integers(0, 120, (2, 900))
        links = [(int(x), int(y), float(w)) for x, y, w in zip(a, b, rng.uniform(0.1, 3, 900), strict=True)]
    return links


def dense(links):
    nodes = sorted({n for a, b, _ in links if a != b for n in (a, b)})
    at = {n: i for i, n in enumerate(nodes)}
    w = np.zeros((len(nodes), len(nodes)))
    for a, b, x in links:
        if a != b:
            w[at[a], at[b]] += x
            w[at[b], at[a]] += x
    root = np.sqrt(w.sum(1))
    return nodes, np.eye(len(nodes)) - w / root[:, None] / root


@pytest.mark.parametrize("kind", ["hub", "components", "random"])
def test_against_numpy(spark, kind):
    links = graph(kind)
    nodes, exact = dense(links)
    values, residuals, vectors = laplacian.laplacian_vectors(spark.createDataFrame(links, LINK), 4, widest=60)
    found = {r.id: r.vec for r in vectors.collect()}
    v = np.array([found[n] for n in nodes])
    assert np.allclose(values, np.linalg.eigvalsh(exact)[:4], atol=1e-9)
    assert np.linalg.norm(exact @ v - v * values, axis=0).max() < 1e-7 and residuals.max() < 1e-7
    assert np.allclose(v.T @ v, np.eye(4), atol=1e-9)


def test_odd_links(spark):
    """Loops, nulls, weights of no use and links given twice; few nodes; none at all."""
    rows = [(1, 1, 5.0), (1, 2, 1.0), (1, 2, 1.0), (2, 3, 2.0), (3, None, 1.0), (None, 3, 1.0), (1, 9, 0.0), (1, 9, -1.0), (1, 9, None), (2, 9, float("nan")), (2, 9, float("inf"))]
    values, _, vectors = laplacian.laplacian_vectors(spark.createDataFrame(rows, LINK), 5)
    assert np.allclose(values, [0, 1, 2], atol=1e-9)
    assert sorted(r.id for r in vectors.collect()) == [1, 2, 3]
    values, _, vectors = laplacian.laplacian_vectors(spark.createDataFrame([], LINK), 5)
    assert len(values) == 0 and vectors.count() == 0
    assert cluster.spectral_clusters(spark.createDataFrame([], LINK), 3).count() == 0


def test_clusters_follow_weak_cuts(spark):
    links = [(g * 20 + i, g * 20 + (i + s) % 20, 1.0) for g in range(3) for i in range(20) for s in (1, 2, 3)]
    links += [(0, 20, 0.01), (20, 40, 0.01)]
    found = {r.id: r.cluster for r in cluster.spectral_clusters(spark.createDataFrame(links, LINK), 3).collect()}
    groups = [{found[g * 20 + i] for i in range(20)} for g in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set().union(*groups)) == 3


def test_first_vector_is_known_at_once(spark):
    """Many dense parts in a chain of single links have values near zero in plenty, yet the first vector needs no step."""
    links = [(g * 8 + i, g * 8 + j, 1.0) for g in range(40) for i in range(8) for j in range(i)]
    links += [(g * 8, g * 8 + 8, 1e-3) for g in range(39)]
    nodes, exact = dense(links)
    values, residuals, vectors = laplacian.laplacian_vectors(spark.createDataFrame(links, LINK), 1, oversample=4, widest=12, most_steps=1)
    found = {r.id: r.vec[0] for r in vectors.collect()}
    v = np.abs([found[n] for n in nodes])
    assert np.linalg.norm(exact @ v) < 1e-8 and abs(values[0]) < 1e-12 and residuals[0] < 1e-8


def test_small_graphs_need_no_steps(spark):
    """Values that lie close together do not matter where the space spans all nodes."""
    a, b = np.random.default_rng(8).integers(0, 260, (2, 4000))
    links = [(int(x), int(y), 1.0) for x, y in zip(a, b, strict=True)]
    nodes, exact = dense(links)
    values, residuals, _ = laplacian.laplacian_vectors(spark.createDataFrame(links, LINK), 4, most_steps=1)
    assert np.allclose(values, np.linalg.eigvalsh(exact)[:4], atol=1e-9) and residuals.max() < 1e-8


def test_small_graphs_are_solved_in_one_task(spark, monkeypatch):
    """No sketch, and so no triangles as wide as the graph, for few nodes."""
    monkeypatch.setattr(laplacian, "orthonormal", None)
    for kind in ("hub", "components"):
        links = graph(kind)
        nodes, exact = dense(links)
        values, residuals, vectors = laplacian.laplacian_vectors(spark.createDataFrame(links, LINK), 4)
        v = np.array([r.vec for r in sorted(vectors.collect(), key=lambda r: r.id)])
        assert np.allclose(values, np.linalg.eigvalsh(exact)[:4], atol=1e-9) and residuals.max() < 1e-9
        assert np.linalg.norm(exact @ v - v * values, axis=0).max() < 1e-9 and np.allclose(v.T @ v, np.eye(4), atol=1e-9)


@pytest.mark.parametrize("kind", ["hub", "components", "random"])
def test_steps_within_a_task(kind):
    import pyarrow as pa

    links = [link for link in graph(kind) if link[0] != link[1]]
    nodes, exact = dense(links)
    own = laplacian._Graph(pa.table(dict(zip(("src", "dst", "weight"), map(list, zip(*links, strict=True)), strict=True))))
    values, vectors, residuals = laplacian._krylov(own, 4, 1e-8, 800, 0)
    v = vectors[np.argsort(own.ids.to_numpy())]
    assert np.allclose(2 * (1 - values), np.linalg.eigvalsh(exact)[:4], atol=1e-9) and 2 * residuals.max() <= 1e-8
    assert np.linalg.norm(exact @ v - v * (2 * (1 - values)), axis=0).max() < 1e-7 and np.allclose(v.T @ v, np.eye(4), atol=1e-9)
