"""Smallest eigenvectors of a graph's normalised Laplacian, for any number of nodes and links.

L = I - D^-1/2 W D^-1/2 has its smallest eigenvalues where (2 I - L) / 2 has its largest, and that matrix has
none below zero. A block Krylov space of it grows by one distributed product a step; the small projected problem
gives values, vectors and the length of every residual, all read off one merged triangle. A wide space starts
again from its best vectors. The driver and every task hold squares of the space's width.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.plans.sketch import AT_ONCE, LITTLE, Factor, extended, orthonormal, tall_r, times, turned
from tabloom.plans.storage import scratch, written

#: Numbers that a basis should hold, and the columns that it may have at least and at most.
BASIS, LEAST, MOST = 1 << 25, 192, 512
#: Up to so many nodes and links one task takes the steps, in a space of ``HELD`` numbers, as each would cost more in jobs than in work.
NODES, LINKS, HELD = 1 << 18, 1 << 23, 1 << 24
#: Up to so many nodes the matrix is solved whole, without steps.
SPAN = 2048


def half_walk(links: DataFrame) -> DataFrame:
    """(i, k, a): (I + D^-1/2 W D^-1/2) / 2 of the links (src, dst, weight), taken both ways.

    Links of a node with itself, of weight 0 or less, and with a null go; links met more often add up.
    """
    both = _both_ways(links)
    return _walk(both, _degrees(both))


def _both_ways(links: DataFrame) -> DataFrame:
    """The links that count, summed, from either end."""
    good = links.filter("src <> dst AND weight > 0 AND weight < double('infinity')")
    both = good.select("src", "dst", "weight").unionByName(good.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return written(both.groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "both-ways")


def _degrees(both: DataFrame) -> DataFrame:
    return written(both.groupBy("src").agg(F.sum("weight").alias("degree")), "degrees")


def _walk(both: DataFrame, degree: DataFrame) -> DataFrame:
    """``half_walk`` of links from either end, with (src, degree)."""
    of = lambda name: degree.select(F.col("src").alias(name), F.sqrt("degree").alias(f"{name}_root"))
    walk = both.join(of("src"), "src").join(of("dst"), "dst")
    off = walk.select(F.col("src").alias("i"), F.col("dst").alias("k"), (F.col("weight") / (2 * F.col("src_root") * F.col("dst_root"))).alias("a"))
    return off.unionByName(degree.select(F.col("src").alias("i"), F.col("src").alias("k"), F.lit(0.5).alias("a")))


class _Graph:
    """(I + D^-1/2 W D^-1/2) / 2 of links given once, as sorted entries that multiply a block of vectors."""

    def __init__(self, links: pa.Table):
        ends = [links.column(c).combine_chunks() for c in ("src", "dst")]
        self.ids = pa.concat_arrays(ends).unique()
        a, b = (pc.index_in(end, value_set=self.ids).to_numpy().astype(np.int32) for end in ends)
        weight, n = links.column("weight").to_numpy(), len(self.ids)
        self.root = np.sqrt(np.bincount(a, weight, n) + np.bincount(b, weight, n))
        a, b, weight = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([weight, weight])
        order = np.argsort(a, kind="stable")
        self.row, self.col = a[order], b[order]
        self.value = weight[order] / (2 * self.root[self.row] * self.root[self.col])
        self.starts = np.flatnonzero(np.diff(self.row, prepend=-1))  # every node has a link

    def dense(self) -> np.ndarray:
        out = np.eye(len(self.ids)) / 2
        out[self.row, self.col] = self.value
        return out

    def times(self, block: np.ndarray) -> np.ndarray:
        out, step = block / 2, max(1, AT_ONCE // 4 // block.shape[1])
        for low in range(0, len(self.row), step):
            part = slice(low, low + step)
            starts = np.flatnonzero(np.diff(self.row[part], prepend=-1))
            out[self.row[part][starts]] += np.add.reduceat(self.value[part, None] * block[self.col[part]], starts, axis=0)
        return out


def _krylov(graph: _Graph, k: int, tol: float, most_steps: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residuals) of the ``k`` largest values: the restarted block Krylov space of this module, in memory."""
    n = len(graph.ids)
    width, widest = min(k + 16, n), min(n, max(64, 3 * k + 48, min(LEAST, HELD // n)))
    start = np.random.default_rng(seed).standard_normal((n, width))
    start[:, 0] = graph.root
    basis = np.linalg.qr(start)[0]
    image = newest = graph.times(basis)
    for step in range(most_steps + 1):
        small = basis.T @ image
        values, directions = np.linalg.eigh((small + small.T) / 2)
        values, directions = values[::-1], directions[:, ::-1]
        best = directions[:, :k]
        residuals = np.linalg.norm(image @ best - (basis @ best) * values[:k], axis=0)
        if 2 * residuals.max() <= tol or step == most_steps:
            break
        if basis.shape[1] + newest.shape[1] > widest:
            basis = np.linalg.qr(basis @ directions[:, :width])[0]
            image = newest = graph.times(basis)
        more = newest
        for _ in range(2):
            more = more - basis @ (basis.T @ more)
            left, sizes, _ = np.linalg.svd(more, full_matrices=False)
            more = left[:, sizes > LITTLE * max(1.0, sizes[0])] if sizes.size else left
        if not more.shape[1]:  # the space holds all its images
            break
        newest = graph.times(more)
        basis, image = np.hstack([basis, more]), np.hstack([image, newest])
    return values[:k], basis @ best, residuals


def _whole(both: DataFrame, k: int, tol: float, most_steps: int, seed: int) -> DataFrame:
    """(k, vec, value, residual) of a graph whose links fit into one task; ``both`` has the links (src, dst, weight) both ways."""

    def solve(links: pa.Table) -> pa.Table:
        graph = _Graph(links)
        if len(graph.ids) <= SPAN:
            matrix = graph.dense()
            values, vectors = np.linalg.eigh(matrix)
            values, vectors = values[: -k - 1 : -1], vectors[:, : -k - 1 : -1]
            residuals = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
        else:
            values, vectors, residuals = _krylov(graph, k, tol, most_steps, seed)
        lists = lambda rows: pa.array(list(rows), pa.list_(pa.float64()))
        n = len(graph.ids)
        return pa.table({"k": graph.ids, "vec": lists(vectors), "value": lists([values] * n), "residual": lists([residuals] * n)})

    kind = both.schema["src"].dataType.simpleString()
    once = both.filter("src < dst").groupBy(F.lit(0).alias("at"))
    return written(once.applyInArrow(solve, f"k {kind}, vec array<double>, value array<double>, residual array<double>"), "solved")


def _ritz(basis: DataFrame, image: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, directions, residuals), largest values first, of a symmetric matrix on an orthonormal basis and its image."""
    wide = basis.select(F.size("vec")).first()[0]
    both = basis.join(image.select("k", F.col("vec").alias("_image")), "k").select("k", F.concat("vec", "_image").alias("vec"))
    r = tall_r(both)
    small = np.linalg.solve(r[:wide, :wide], r[:wide, wide:])
    values, directions = np.linalg.eigh((small + small.T) / 2)
    values, directions = values[::-1], directions[:, ::-1]
    residuals = np.linalg.norm(r[:, wide:] @ directions - (r[:, :wide] @ directions) * values, axis=0)
    return values, directions, residuals


def laplacian_vectors(
    links: DataFrame, k: int, *, oversample: int | None = None, widest: int | None = None, tol: float = 1e-8, most_steps: int = 200, seed: int = 0
) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """(eigenvalues ascending, residual lengths, (id, vec)) of the normalised Laplacian of (src, dst, weight).

    ``vec`` holds a node's entries in the ``k`` vectors of unit length; nodes without a link are in none. Fewer
    come back for fewer nodes; no links give none. Steps go on until each residual ``|L v - e v|`` is at most
    ``tol``; ``most_steps`` without that raise. The space has up to ``widest`` columns and ``k + oversample`` at the
    start; if not given, they are as many as ``BASIS`` numbers allow, since wide blocks need few steps, and a graph
    of at most ``NODES`` nodes and ``LINKS`` links is solved within a task. As many values are zero as the graph has components, up to ``k``.
    """
    with scratch():
        both = _both_ways(links)
        degree = _degrees(both)
        nodes = degree.select(F.col("src").alias("k"), F.sqrt("degree").alias("root"))
        total = nodes.count()
        if not total:
            kind = links.schema["src"].dataType.simpleString()
            return np.zeros(0), np.zeros(0), links.sparkSession.createDataFrame([], f"id {kind}, vec array<double>")
        if widest is None and total <= NODES and both.count() <= 2 * LINKS:
            solved = _whole(both, k, tol, 4 * most_steps, seed)
            first = solved.first()
            values, residuals = np.array(first["value"]), 2 * np.array(first["residual"])
            if residuals.max() <= tol:
                # In the order of the nodes, as the other way leaves them: k-means starts from rows by their place.
                vectors = written(nodes.join(solved, "k", "left").select(F.col("k").alias("id"), "vec"), "laplacian-vectors", outlive=True)
                return 2 * (1 - values), residuals, vectors
        matrix = Factor(written(_walk(both, degree), "half-walk"))
        widest = widest or min(MOST, max(LEAST, BASIS // total))
        width = min(k + (max(16, widest // 8) if oversample is None else oversample), total)
        unit = lambda j, salt: (F.xxhash64("k", j, F.lit(seed), F.lit(salt)).bitwiseAND(F.lit((1 << 52) - 1)) + 1) / float(1 << 52)
        normal = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: F.sqrt(-2 * F.log(unit(j, 1))) * F.cos(2 * math.pi * unit(j, 2)))
        # The roots of the degrees are a vector of value 0 in any graph, so it need not be found.
        basis = orthonormal(written(nodes.select("k", F.concat(F.array("root"), normal).alias("vec")), "start"))
        image = newest = times(matrix, basis)
        for _ in range(most_steps):
            values, directions, residuals = _ritz(basis, image)
            if 2 * residuals[:k].max() <= tol:
                break
            if len(values) >= widest:  # again from the best vectors; their images turn alike
                best = directions[:, :width]
                basis = orthonormal(turned(basis, best))
                image = newest = times(matrix, basis)
            basis, added = extended(basis, newest)
            if added is None:  # the space holds all its images but for rounding, so nothing nearer can come
                break
            newest = times(matrix, added)
            image = written(image.join(newest.select("k", F.col("vec").alias("_new")), "k").select("k", F.concat("vec", "_new").alias("vec")), "image")
        else:
            raise RuntimeError(f"residuals of {2 * residuals[:k].max():.1e} are left after {most_steps} steps")
        vectors = written(turned(basis, directions[:, :k]), "laplacian-vectors", outlive=True)
    return 2 * (1 - values[:k]), 2 * residuals[:k], vectors.select(F.col("k").alias("id"), "vec")
