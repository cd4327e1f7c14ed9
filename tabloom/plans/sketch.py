"""Leading singular vectors of a sparse table by random sketches, for any number of rows and columns.

The table is only ever multiplied by narrow tall matrices, in blocks; tall matrices are made orthonormal by a QR
that merges small triangles in a tree. The driver and every task hold squares of the sketch's width.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.plans.storage import written

#: Groups that triangles are merged in before the last merge.
FAN = 64
#: Numbers of a dense block, and entries of a sparse one, that a task holds.
AT_ONCE, ENTRIES = 1 << 22, 1 << 21
#: Directions below this share of the longest are no part of a range.
NOTHING = 1e-12
#: What a power step adds counts from this share of its length on.
LITTLE = 1e-9


def _triangle(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
    """The triangle of all rows of the blocks; short blocks wait until together they are worth a QR."""
    held, rows = [], 0
    for block in blocks:
        held.append(block)
        rows += len(block)
        if rows >= 2 * block.shape[1]:
            held = [np.linalg.qr(np.vstack(held), mode="r")]
            rows = len(held[0])
    return np.linalg.qr(np.vstack(held), mode="r") if held else None


def tall_r(rows: DataFrame, vector: str = "vec", fan: int = FAN) -> np.ndarray:
    """The triangle R of the QR of all rows: one triangle a task, merged in ``fan`` groups and then in one, all in one job."""
    kind = "at long, wide int, r binary"
    schema = pa.schema([("at", pa.int64()), ("wide", pa.int32()), ("r", pa.binary())])

    def local(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = _triangle(part.column(0).flatten().to_numpy().reshape(part.num_rows, -1) for part in parts if part.num_rows)
        if upper is not None:
            yield pa.RecordBatch.from_pydict({"at": [TaskContext.get().partitionId()], "wide": [upper.shape[1]], "r": [upper.tobytes()]}, schema=schema)

    def merged(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("at")
        upper = _triangle(np.frombuffer(r).reshape(-1, wide) for wide, r in zip(some["wide"], some["r"], strict=True))
        return pd.DataFrame({"at": [key[0]], "wide": [upper.shape[1]], "r": [upper.tobytes()]})

    triangles = rows.select(vector).mapInArrow(local, kind)
    triangles = triangles.groupBy((F.col("at") % fan).alias("at")).applyInPandas(merged, kind)
    last = triangles.groupBy(F.lit(0).alias("at")).applyInPandas(merged, kind).first()
    return np.zeros((0, 0)) if last is None else np.frombuffer(last["r"]).reshape(-1, last["wide"])


def turned(rows: DataFrame, by: np.ndarray, vector: str = "vec") -> DataFrame:
    """Each row's vector times a small matrix."""

    @F.pandas_udf("array<double>")
    def times(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(vectors.to_numpy()) @ by)) if len(vectors) else pd.Series([], dtype=object)

    return rows.withColumn(vector, times(vector))


def orthonormal(rows: DataFrame, vector: str = "vec") -> DataFrame:
    """The rows of an orthonormal basis of the column space of ``rows``; dependent columns fall out. Done twice for accuracy."""
    for _ in range(2):
        r = tall_r(rows, vector)
        if not r.size:
            return rows
        _, sizes, right = np.linalg.svd(r)
        keep = sizes > NOTHING * sizes[0] if sizes[0] else sizes > 0
        rows = turned(rows, right[: len(sizes)][keep].T / sizes[keep], vector)
    return written(rows, "orthonormal")


def extended(basis: DataFrame, block: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``basis`` with what ``block`` adds to its range, and the added columns alone (None if it adds nothing).

    ``basis`` is orthonormal and has every row; rows that ``block`` lacks are zero there. The triangle of both
    side by side holds the block's shares of the basis, which are taken off, twice for accuracy.
    """
    old, wide = basis.select(F.size("vec")).first()[0], block.select(F.size("vec")).first()
    if wide is None:
        return basis, None
    zeros = F.array_repeat(F.lit(0.0), wide[0])
    both = written(basis.join(block.select("k", F.col("vec").alias("_more")), "k", "left").select("k", F.concat("vec", F.coalesce("_more", zeros)).alias("vec")), "sketch")
    for _ in range(2):
        r = tall_r(both)
        share, rest = np.linalg.solve(r[:old, :old], r[:old, old:]), r[old:, old:]
        _, sizes, right = np.linalg.svd(rest)
        keep = sizes > LITTLE * np.linalg.norm(r[:, old:]) if sizes.size else np.zeros(0, bool)
        if not keep.any():
            return basis, None
        add = np.vstack([-share, np.eye(share.shape[1])]) @ (right[: len(sizes)][keep].T / sizes[keep])
        both = turned(both, np.hstack([np.eye(old + share.shape[1])[:, :old], add]))
    both = written(both, "sketch-basis")
    return both, both.select("k", F.slice("vec", old + 1, int(keep.sum())).alias("vec"))


class Factor:
    """A matrix ``(i, k, a)`` that tall matrices are multiplied by, with its size counted once."""

    def __init__(self, entries: DataFrame):
        self.entries = entries.select("i", "k", F.col("a").cast("double").alias("a"))
        counts = entries.agg(F.approx_count_distinct("i"), F.approx_count_distinct("k"), F.count(F.lit(1))).first()
        self.rows, self.cols, self.size = (max(1, n) for n in counts)


def _cell_product(left: pa.Table, right: pa.Table) -> pa.Table:
    """The rows of a block's entries times the vectors of its columns, one vector a row met."""
    ids, vecs = left.column("i").combine_chunks(), right.column("vec").combine_chunks()
    at = pc.index_in(left.column("k").combine_chunks(), value_set=right.column("k").combine_chunks(), skip_nulls=True)
    known = pc.is_valid(at)
    ids = ids.filter(known)
    if not len(ids):
        return pa.table({"k": pa.array([], ids.type), "vec": pa.array([], pa.list_(pa.float64()))})
    at = at.filter(known).to_numpy()
    b = vecs.flatten().to_numpy().reshape(len(vecs), -1)
    a = left.column("a").combine_chunks().filter(known).to_numpy()
    codes = ids.dictionary_encode(null_encoding="encode")
    row = codes.indices.to_numpy()
    order = np.argsort(row, kind="stable")
    row, at, a = row[order], at[order], a[order]
    wide, out = b.shape[1], np.zeros((len(codes.dictionary), b.shape[1]))
    step = max(1, AT_ONCE // max(1, wide))
    for low in range(0, len(row), step):
        part = slice(low, low + step)
        starts = np.flatnonzero(np.diff(row[part], prepend=-1))
        out[row[part][starts]] += np.add.reduceat(a[part, None] * b[at[part]], starts, axis=0)
    offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * wide)
    return pa.table({"k": codes.dictionary, "vec": pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))})


def times(matrix: Factor | DataFrame, rows: DataFrame, wide: int | None = None, *, store: bool = True) -> DataFrame:
    """(k, vec): the matrix ``(i, k, a)`` times the tall matrix ``(k, vec)``, named by ``i``. Rows without entries do not appear.

    A task meets a block of entries with the vectors of its columns and gives one summed vector for each of its rows,
    so what moves are whole vectors: one for a row and block of columns, and one for a column and block of rows.
    ``wide`` is the length of the vectors, if known. What is read once only need not be a stored table.
    """
    matrix = matrix if isinstance(matrix, Factor) else Factor(matrix)
    if wide is None:
        first = rows.select(F.size("vec")).first()
        wide = first[0] if first else 1
    most = max(1, AT_ONCE // max(1, wide))  # vectors that a task holds on either side
    n_i, n_k = (max(1, math.ceil(n / most)) for n in (matrix.rows, matrix.cols))
    more = math.ceil(matrix.size / ENTRIES / (n_i * n_k))
    n_i, n_k = (n_i * more, n_k) if matrix.rows >= matrix.cols else (n_i, n_k * more)
    block = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    left = matrix.entries.select("i", "k", "a", block("i", n_i).alias("bi"), block("k", n_k).alias("bk"))
    right = rows.select("k", "vec", F.explode(F.sequence(F.lit(0), F.lit(n_i - 1))).alias("bi"), block("k", n_k).alias("bk"))
    kind = matrix.entries.schema["i"].dataType.simpleString()
    parts = left.groupBy("bi", "bk").cogroup(right.groupBy("bi", "bk")).applyInArrow(_cell_product, f"k {kind}, vec array<double>")
    if n_k > 1:
        add = lambda x, y: F.zip_with(x, y, lambda u, v: u + v)
        parts = parts.groupBy("k").agg(F.collect_list("vec").alias("all"))
        parts = parts.select("k", F.aggregate(F.slice("all", 2, n_k), F.col("all")[0], add).alias("vec"))
    return written(parts, "sketch") if store else parts


def asked_products(entries: DataFrame, vectors: DataFrame, asked: DataFrame, wide: int) -> DataFrame:
    """(i, j, dot) for the pairs ``asked(i, j)``: row ``i`` of ``entries(i, k, a)`` times the tall matrix ``(k, vec)``, times the vector of ``j``.

    A task meets a block of rows, with all they ask, with a slice of the columns of the tall matrix, so the products of
    the rows never leave it. Pairs whose ``i`` has no entry or whose ``j`` no vector do not appear, repeated ones once.
    """
    sizes = entries.agg(F.approx_count_distinct("i").alias("i"), F.approx_count_distinct("k").alias("k"), F.count(F.lit(1)).alias("n")).first()
    width = max(1, min(wide, AT_ONCE // max(1, sizes["k"])))
    n_slices = math.ceil(wide / width)
    n_rows = max(1, math.ceil(sizes["i"] * width / AT_ONCE), math.ceil(sizes["n"] / ENTRIES))
    block = F.pmod(F.xxhash64("i"), F.lit(n_rows)).cast("int").alias("block")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    kind_i, kind_k = (entries.schema[c].dataType for c in "ik")
    wanted = asked.select(F.col("i").cast(kind_i).alias("i"), F.col("j").cast(kind_k).alias("k"), F.lit(None).cast("double").alias("a"), F.lit(True).alias("asked"))
    left = entries.select("i", "k", F.col("a").cast("double").alias("a"), F.lit(False).alias("asked")).unionByName(wanted.dropna(subset=["i", "k"]))
    left = left.select("*", block, every(n_slices).alias("slice"))
    right = vectors.select("k", "vec", every(n_rows).alias("block")).select("*", every(n_slices).alias("slice"))
    right = right.select("block", "slice", "k", F.slice("vec", F.col("slice") * width + 1, F.lit(width)).alias("vec"))

    def cell(own: pa.Table, tall: pa.Table) -> pa.Table:
        pairs, own = own.filter(own.column("asked")), own.filter(pc.invert(own.column("asked")))
        rows = _cell_product(own, tall)
        ids = [(rows.column("k").combine_chunks(), pairs.column("i")), (tall.column("k").combine_chunks(), pairs.column("k"))]
        at_i, at_k = (pc.index_in(c.combine_chunks(), value_set=known, skip_nulls=True) for known, c in ids)
        met = pc.and_(pc.is_valid(at_i), pc.is_valid(at_k))
        pairs = pairs.select(["i", "k"]).rename_columns(["i", "j"]).filter(met)
        both = np.stack([at.filter(met).to_numpy().astype(np.int64) for at in (at_i, at_k)])
        first = np.unique(both[0] * max(1, tall.num_rows) + both[1], return_index=True)[1]
        if not len(first):
            return pairs.append_column("dot", pa.array([], pa.float64()))
        (x, y), both = (table.column("vec").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1) for table in (rows, tall)), both[:, first]
        dots, step = np.zeros(len(first)), max(1, AT_ONCE // 4 // x.shape[1])
        for low in range(0, len(first), step):
            i, k = both[:, low : low + step]
            dots[low : low + step] = np.einsum("ij,ij->i", x[i], y[k])
        return pairs.take(pa.array(first)).append_column("dot", pa.array(dots))

    kinds = f"i {kind_i.simpleString()}, j {kind_k.simpleString()}, dot double"
    dots = left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInArrow(cell, kinds)
    return dots if n_slices == 1 else dots.groupBy("i", "j").agg(F.sum("dot").alias("dot"))


def singular_vectors(matrix: DataFrame, k: int, *, oversample: int = 100, rounds: int = 2, tol: float = 1e-6, seed: int = 0) -> tuple[np.ndarray, DataFrame]:
    """The ``k`` largest singular values of ``(i, k, a)``, and ``(k, vec)`` with the right singular vectors' entries.

    Normal numbers from the hash of (column, place) start a sketch of ``k + oversample`` columns. Power steps add
    their ranges to it (a block Krylov space), and the SVD of the matrix on that space gives values and vectors;
    after every ``rounds`` steps the values are looked at, until they keep within ``tol`` or nothing is left to
    add. Fewer come back if the rank is smaller. A sketch as wide as the matrix spans all and needs no steps.
    """
    kinds = matrix.schema["k"].dataType.simpleString()
    columns = written(matrix.select("k").distinct(), "sketch-columns")
    total = columns.count()
    if not total:
        return np.zeros(0), matrix.sparkSession.createDataFrame([], f"k {kinds}, vec array<double>")
    width = min(k + oversample, total)

    def unit(j: Column, salt: int) -> Column:
        return (F.xxhash64("k", j, F.lit(seed), F.lit(salt)).bitwiseAND(F.lit((1 << 52) - 1)) + 1) / float(1 << 52)

    normal = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: F.sqrt(-2 * F.log(unit(j, 1))) * F.cos(2 * math.pi * unit(j, 2)))
    block = basis = orthonormal(written(columns.select("k", normal.alias("vec")), "sketch"))
    flipped, matrix = Factor(matrix.select(F.col("k").alias("i"), F.col("i").alias("k"), "a")), Factor(matrix)
    before = None
    while True:
        for _ in range(rounds):
            if width < total and block is not None:
                basis, block = extended(basis, times(flipped, times(matrix, block)))
        r = tall_r(times(matrix, basis, store=False))
        if not r.size:
            return np.zeros(0), basis.filter(F.lit(False))
        _, values, right = np.linalg.svd(r)
        if width == total or block is None or (before is not None and np.allclose(values[:k], before, rtol=tol, atol=0)):
            break
        before = values[:k]
    keep = [f for f in range(min(k, len(values))) if values[f] > NOTHING * values[0]]
    return values[keep], written(turned(basis, right[keep].T), "singular-vectors")
