"""Nearest neighbours by a permutation index, searched block by block.

A vector is stood for by its nearest pivots in order. Each block of vectors keeps an inverted file:
for every pivot the vectors that have it among their nearest, with the place it takes. A query adds
up its footrule distance over the files of its own pivots, takes the nearest part of the block, and
ranks that by the true inner product. Of the rest, those follow whose inner product could still reach
the last of the best, by their projections on the span of some pivots: nothing is lost at any size.
Equal vectors are one entry of the index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import batch
from tabloom.plans.storage import written

#: Pivots, and how many of them, in order, stand for a vector. They are the bounded sample of the fit.
PIVOTS, NEAREST = 128, 32
#: The part of a block that is ranked first, and its least number of vectors for each one wanted.
PART, LEAST = 0.35, 4
BLOCK, QUERY_BLOCK = 8192, 256


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def places(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of the nearest pivots in order, by largest inner product."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :nearest]


class Block:
    """The inverted files of one block of vectors."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, nearest: int):
        self.vectors, self.nearest = vectors, nearest
        order = places(vectors, pivots, nearest)
        rows, place = np.repeat(np.arange(len(vectors)), nearest), np.tile(np.arange(nearest), len(vectors))
        by = np.argsort(order.ravel(), kind="stable")
        self.rows, self.place = rows[by], place[by].astype(np.float32)
        self.start = np.searchsorted(order.ravel()[by], np.arange(len(pivots) + 1))
        self.basis = np.linalg.qr(pivots[:nearest].T)[0]
        self.inner, self.rest, self.norm = self._projected(vectors)

    def _projected(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coordinates in the span of the first pivots, the norms of what lies outside, and the whole norms."""
        inner = vectors @ self.basis
        return inner, np.linalg.norm(vectors - inner @ self.basis.T, axis=-1), np.linalg.norm(vectors, axis=-1)

    def search(self, query: np.ndarray, order: np.ndarray, most: int, part: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the candidates by the index, and of all others that could be among the ``most`` best."""
        n, m = len(self.vectors), self.nearest
        products = self.vectors @ query  # cheaper than to copy the chosen rows together
        take = max(least, most, int(np.ceil(part * n)))
        if take >= n:
            rows = np.arange(n)
        else:
            # Less than the distance to a vector that shares no pivot, for every pivot shared.
            saved = np.zeros(n, np.float32)
            for at, pivot in enumerate(order):
                a, b = self.start[pivot], self.start[pivot + 1]
                saved[self.rows[a:b]] += 2 * m - at - self.place[a:b] - np.abs(self.place[a:b] - at)
            rows = np.argpartition(-saved, take - 1)[:take]
            scores = products[rows]
            last = np.partition(scores, take - most)[take - most]
            inner, rest, norm = self._projected(query)
            bound = self.inner @ inner + self.rest * rest + 1e-9 * self.norm * norm  # and the rounding
            bound[rows] = -np.inf
            rows = np.concatenate([rows, np.flatnonzero(~(bound < last))])
        return rows, products[rows]


def search(
    table: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20,
    pivots: int = PIVOTS, nearest: int = NEAREST, part: float = PART, least: int | None = None, block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """For each query row its ``k`` nearest other rows by inner product: query_id, rank, vec_id, score.

    Ties go to the smaller id. Vectors that are null, zero, hold null or non-finite components, or
    are not of the commonest length (the greater of equally common ones) take no part. ``least`` candidates come by the index,
    ``LEAST`` for each one wanted if not given; the result is exact at every size. Rows that repeat an id with an equal
    vector count once. Other columns are not read; an empty table gives no rows.
    """
    spark = table.sparkSession
    least = LEAST * (k + 1) if least is None else least
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = common["size"]
    rows = rows.filter(F.size("v") == size)
    # Of equal vectors the k + 1 smallest ids can be among the nearest; the plan limits groups before it shuffles.
    first = Window.partitionBy("v").orderBy("id")
    some = rows.select("id", "v").distinct().withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    classes = some.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("rep", F.col("ids")[0])
    classes = written(classes, "vectors")
    picked = classes.orderBy(F.xxhash64("v"), "rep").limit(pivots).select("v").collect()
    fixed = np.array([p["v"] for p in picked], np.float64)
    near = min(nearest, len(fixed))
    asked = rows.filter("asks").select("id", "v").distinct().join(classes.select("v", "rep"), "v").select("id", "rep")
    asked = written(asked, "queries")
    askers = written(asked.select("rep").distinct().join(classes.select("rep", "v"), "rep"), "asked-vectors")
    n, n_asked = classes.count(), askers.count()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_asked // query_block))
    cell = lambda of, parts: F.pmod(F.xxhash64(of), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    data = classes.select("rep", "v", cell("rep", blocks).alias("b"), every(query_blocks).alias("q"))
    queries = askers.select("rep", "v", cell("rep", query_blocks).alias("q"), every(blocks).alias("b"))
    schema = pa.schema([("q", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], schema)
        matrix = lambda t: np.array(t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, size)
        reps, vectors = left.column("rep").to_numpy(), matrix(left)
        index = Block(vectors, fixed, near)
        asks = matrix(right)
        found = []
        for q, query, order in zip(right.column("rep").to_numpy(), asks, places(asks, fixed, near), strict=True):
            at, scores = index.search(query, order, k + 1, part, least)
            if len(at) > k + 1:  # all that tie with the last one stay in the running
                keep = scores >= np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                at, scores = at[keep], scores[keep]
            best = np.lexsort((reps[at], -scores))[: k + 1]
            found.append(batch(schema, np.full(len(best), q), reps[at[best]], scores[best]))
        return pa.Table.from_batches(found, schema)

    hits = data.groupBy("b", "q").cogroup(queries.groupBy("b", "q")).applyInArrow(work, "q bigint, rep bigint, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    hits = hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).select("q", "rep", "score")
    ids = hits.join(classes.select("rep", "ids"), "rep").select("q", "score", F.explode("ids").alias("vec_id"))
    nearest_ids = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("n", F.row_number().over(nearest_ids)).filter(F.col("n") <= k + 1).select("q", "score", "vec_id")
    # The lists are bounded, so a query's own id is left out without another sort.
    lists = ids.groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("l"))
    own = F.slice(F.filter("l", lambda x: x["vec_id"] != F.col("id")), 1, k)
    return asked.join(lists, F.col("rep") == F.col("q")).select("id", F.posexplode(own).alias("i", "x")).select(
        F.col("id").alias("query_id"), (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score")
    )
