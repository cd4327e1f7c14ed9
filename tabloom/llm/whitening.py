"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred, distinct rows.

With X the centred rows, each step takes the distributed products u = Xv - beta u' and X'u, so that
X V = U B with B upper bidiagonal; the small SVD of B gives the components and deviations. Both bases
are fully reorthogonalised. A left vector is as long as the table: it is kept as X p, with p as short as
a row, and made again where it is needed, so no step stores or shuffles anything but its sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.bpe import _arrow
from tabloom.llm.common import batch
from tabloom.plans.storage import written

#: Entries become floor(SCALE * c) + OFFSET. Components at most, by default.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Singular values below this share of the largest count as zero.
ZERO = 1e-11
#: A component is done when its residual is below this share of the largest singular value.
DONE = 1e-14


@dataclass
class Whitening:
    """``n`` rows were fitted, with ``sums`` of the integer entries; ``basis`` has a component a column."""

    n: int
    dim: int
    sums: list[int] = field(default_factory=list)
    basis: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    variances: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trace: float = 0.0
    identity_error: float = 0.0
    steps: int = 0

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.variances]


def usable(vector: str | Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    entry_ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    vec = (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>")
    return F.coalesce(vec.isNotNull() & F.forall(vec, entry_ok), F.lit(False))


def _rows(vectors: DataFrame, vector: str) -> DataFrame:
    return vectors.filter(usable(vector)).select("*", F.col(vector).cast("array<double>").alias("_vec"))


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have ``dim`` entries, and floor(SCALE * c) of those."""
    right = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False)
    values = column.filter(right).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return right.to_numpy(zero_copy_only=False), np.floor(values * SCALE)


def distinct_rows(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int, str]:
    """Each distinct integer row once, as packed bytes, with the dimension and the type of the entries.

    The dimension is the commonest length of usable vectors, the greater of equally common ones. The
    entries are packed without the offset, in the narrowest integers that hold them all.
    """
    rows = _rows(vectors, vector)
    most = F.greatest(F.abs(F.array_max("_vec")), F.abs(F.array_min("_vec")))
    sizes = rows.groupBy(F.size("_vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(most).alias("most"))
    best = sizes.filter("dim > 0").orderBy(F.desc("n"), F.desc("dim")).first()
    schema = pa.schema([("row", pa.binary())])
    if best is None:
        return vectors.sparkSession.createDataFrame([], "row binary"), 0, "<i2"
    dim, reach = best["dim"], best["most"] * SCALE + 1
    kind = next(k for k, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if reach < 2**bits)

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            packed = _matrix(part.column(0), dim)[1].astype(kind)
            yield batch(schema, [r.tobytes() for r in packed])

    packed = rows.select("_vec").mapInArrow(pack, "row binary")
    return packed.groupBy("row").agg(F.count(F.lit(1)).alias("_n")).select("row"), dim, kind


def _blocks(parts: Iterator[pa.RecordBatch], dim: int, kind: str) -> Iterator[np.ndarray]:
    width = dim * np.dtype(kind).itemsize
    for part in parts:
        if part.num_rows:
            column = part.column(0)
            start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
            yield np.frombuffer(column.buffers()[2], kind, part.num_rows * dim, int(start)).reshape(-1, dim)
            assert width * part.num_rows <= len(column.buffers()[2]) - int(start)


def _summed(packed: DataFrame, dim: int, kind: str, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of rows of a short vector: added up in each task, then by position."""
    schema = pa.schema([("sums", pa.list_(pa.float64()))])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(parts, dim, kind):
            part = of(block)
            total = part if total is None else total + part
        if total is not None:
            yield batch(schema, [total])

    sums = packed.mapInArrow(work, "sums array<double>").select(F.posexplode("sums").alias("at", "v"))
    found = sorted(sums.groupBy("at").agg(F.sum("v").alias("v")).collect())
    return np.array([r["v"] for r in found])


def _exact_sums(packed: DataFrame, dim: int, kind: str) -> tuple[int, list[int]]:
    """Rows, and the exact sum of every dimension (without the offset)."""
    schema = pa.schema([("at", pa.int32()), ("v", pa.decimal128(38, 0))])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dim + 1)
        for block in _blocks(parts, dim, kind):
            exact = block.sum(axis=0, dtype=np.int64) if kind != "<i8" else block.astype(object).sum(axis=0)
            total = [t + int(v) for t, v in zip(total, [len(block), *exact], strict=True)]
        yield batch(schema, range(dim + 1), [Decimal(t) for t in total])

    sums = packed.mapInArrow(work, "at int, v decimal(38,0)").groupBy("at").agg(F.sum("v").alias("v"))
    found = {r["at"]: int(r["v"] or 0) for r in sums.collect()}
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(dim)]


class _Bidiagonal:
    """X V = U B and X'U = V B' + beta v e', one distributed pass a step. U is X P, G is X'U."""

    def __init__(self, multiply: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], dim: int):
        self.multiply, self.dim = multiply, dim
        self.v, self.p, self.g = np.zeros((dim, 0)), np.zeros((dim, 0)), np.zeros((dim, 0))
        self.alphas: list[float] = []
        self.betas: list[float] = []  # betas[k] links step k to step k + 1
        self.starts: list[int] = []
        self.random = np.random.default_rng(13)

    def _away(self, w: np.ndarray) -> np.ndarray:
        for _ in range(2):
            w = w - self.v @ (self.v.T @ w)
        return w

    def start(self) -> np.ndarray | None:
        """A direction among the rows that the basis misses, or None if it misses none."""
        r = self._away(self.random.standard_normal(self.dim))
        if len(self.alphas) >= self.dim or np.linalg.norm(r) < 1e-9:
            return None
        sums, g = self.multiply(r[:, None])
        w = self._away(g)
        size = np.linalg.norm(w)
        largest = max(self.alphas, default=0.0)
        if sums[0] <= 0 or size <= max(ZERO * largest, 1e-300) * np.linalg.norm(g) or np.sqrt(sums[0]) <= ZERO * largest * np.linalg.norm(r):
            return None
        self.starts.append(len(self.alphas))
        return self._away(w / size) / np.linalg.norm(self._away(w / size))

    def step(self, v: np.ndarray) -> bool:
        """Take in one more right vector; False if the rows have nothing in its direction."""
        k = len(self.alphas)
        beta = self.betas[-1] if k and self.starts[-1] != k else 0.0
        raw = v - beta * self.p[:, -1] if beta else v
        sums, g = self.multiply(np.column_stack([self.p, raw]))
        h, square = sums[:-1], sums[-1]  # U'u and u'u
        alpha = float(np.sqrt(max(0.0, square - h @ h)))
        if alpha <= ZERO * max(self.alphas, default=0.0) or alpha == 0:
            return False
        self.v = np.column_stack([self.v, v])
        self.p = np.column_stack([self.p, (raw - self.p @ h) / alpha])
        self.g = np.column_stack([self.g, (g - self.g @ h) / alpha])
        self.alphas.append(alpha)
        return True

    def following(self) -> np.ndarray | None:
        """The next right vector of this run, or None where the run has found an invariant space."""
        w = self._away(self.g[:, -1] - self.alphas[-1] * self.v[:, -1])
        beta = float(np.linalg.norm(w))
        self.betas.append(beta)
        if len(self.alphas) >= self.dim or beta <= ZERO * max(self.alphas):
            self.betas[-1] = 0.0
            return None
        w = self._away(w / beta)
        return w / np.linalg.norm(w)

    def matrix(self, start: int = 0) -> np.ndarray:
        b = np.diag(self.alphas[start:])
        for k in range(start, len(self.alphas) - 1):
            if k + 1 not in self.starts:
                b[k - start, k + 1 - start] = self.betas[k]
        return b

    def settled(self, wanted: int) -> bool:
        """Whether the leading values, and the largest of the present run, have converged."""
        if len(self.alphas) < wanted:
            return False
        last, values, _ = np.linalg.svd(self.matrix())
        if np.any(self.betas[-1] * np.abs(last[-1, :wanted]) > DONE * values[0]):
            return False
        last, values, _ = np.linalg.svd(self.matrix(self.starts[-1]))
        return bool(self.betas[-1] * abs(last[-1, 0]) <= 1e-7 * values[0])

    def leading(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Singular values and right vectors, largest first."""
        _, values, right = np.linalg.svd(self.matrix())
        keep = [i for i in range(min(wanted, len(values))) if values[i] > ZERO * values[0]]
        return values[keep], self.v @ right[keep].T


def _decompose(multiply: Callable, dim: int, wanted: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Runs end in an invariant space or settled; a fresh run beside them then looks for repeated values.

    The work is over when a settled run has changed none of the wanted values, or nothing is left.
    """
    basis, before = _Bidiagonal(multiply, dim), None
    v = basis.start()
    while v is not None and basis.step(v):
        v = basis.following()
        if v is not None and not basis.settled(wanted):
            continue
        if v is not None:
            now = basis.leading(wanted)[0]
            if before is not None and len(now) == len(before) and np.allclose(now, before, rtol=1e-12, atol=0):
                break
            before = now
            basis.betas[-1] = 0.0
        v = basis.start()
    if not basis.alphas:
        return np.zeros(0), np.zeros((dim, 0)), 0
    return *basis.leading(wanted), len(basis.alphas)


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on each distinct integer row once.

    Vectors that are null, or hold null or non-finite entries, or are not of the commonest length, take
    no part. Directions without variance are no components, so there may be fewer than asked for, and
    none in an empty table or with one distinct row. The driver sees sums as long as a row.
    """
    packed, dim, kind = distinct_rows(vectors, vector)
    if not dim:
        return Whitening(0, 0)
    packed = written(packed, "distinct-vectors")
    n, sums = _exact_sums(packed, dim, kind)
    # Entries less the whole part of the mean are small and exact; the broken part then goes in floating point.
    whole = np.array([s // n for s in sums], dtype=np.int64)
    broken = np.array([(s % n) / n for s in sums])

    def centred(block: np.ndarray) -> np.ndarray:
        return (block.astype(np.int64) - whole).astype(np.float64) - broken

    def multiply(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def of(block: np.ndarray) -> np.ndarray:
            x = centred(block)
            u = x @ p
            return np.concatenate([u.T @ u[:, -1], x.T @ u[:, -1]])

        out = _summed(packed, dim, kind, of)
        return out[: p.shape[1]], out[p.shape[1] :]

    values, basis, steps = _decompose(multiply, dim, min(components, dim))
    trace = float(_summed(packed, dim, kind, lambda block: np.array([np.square(centred(block)).sum()]))[0]) / n
    variances = values**2 / n
    error = 0.0
    if len(values):
        shares = basis / np.sqrt(variances)

        def moments(block: np.ndarray) -> np.ndarray:
            z = centred(block) @ shares
            return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

        k = len(values)
        out = _summed(packed, dim, kind, moments) / n
        error = float(np.abs(out[k:].reshape(k, k) - np.outer(out[:k], out[:k]) - np.eye(k)).max())
    return Whitening(n, dim, sums, basis, variances, trace, error, steps)


def transform(vectors: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, ``whitened`` (a value a component) and ``deviation`` of every vector that takes part.

    ``deviation`` is the exact sum over the dimensions of (n * x - sum)^2. Repeated keys give a row each,
    a null key stays null. Columns besides the two are not read.
    """
    kind = vectors.schema[key].dataType.simpleString()
    schema = pa.schema([("key", _arrow(kind)), ("whitened", pa.list_(pa.float64())), ("deviation", pa.decimal128(38, 0))])
    n, sums = model.n, model.sums
    whole = np.array([s // n for s in sums], dtype=np.float64)
    broken = np.array([(s % n) / n for s in sums])
    shares = model.basis / np.sqrt(model.variances)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            right, x = _matrix(part.column(1), model.dim)
            reach = (int(np.abs(x).max(initial=0)) * n + max(map(abs, sums))) ** 2 * model.dim
            exact = np.int64 if reach < 2**63 else object
            gaps = (x.astype(np.int64).astype(exact) * n) - np.array(sums, dtype=exact)
            deviation = [Decimal(int(d)) for d in np.square(gaps).sum(axis=1)]
            yield batch(schema, part.column(0).filter(pa.array(right)).cast(schema.field(0).type), list(((x - whole) - broken) @ shares), deviation)

    if not model.n:
        work = lambda parts: iter(())
    rows = _rows(vectors, vector).select(F.col(key).alias("key"), "_vec")
    return rows.mapInArrow(work, f"key {kind}, whitened array<double>, deviation decimal(38,0)").withColumnRenamed("key", key)
