"""Product of two sparse tables by blocks.

A plain join on the inner index emits one row per matching pair of entries, all of them for a
popular index. Here a task meets one block of each factor and emits the block's product,
summed over a whole chunk of the inner index.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _block_product(values: Sequence[str]):
    def cell(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"i": [], "j": [], **{v: [] for v in values}})
        asked = None
        if "asked" in right:
            asked, right = right[right["asked"]], right[~right["asked"]]
        if left.empty or right.empty or (asked is not None and asked.empty):
            return empty
        rows, at_row = np.unique(left["i"].to_numpy(), return_inverse=True)
        cols, at_col = np.unique(right["j"].to_numpy(), return_inverse=True)
        inner = np.intersect1d(left["k"].to_numpy(), right["k"].to_numpy())
        if len(inner) == 0:
            return empty
        keep_l, keep_r = np.isin(left["k"], inner), np.isin(right["k"], inner)
        a = np.zeros((len(rows), len(inner)))
        np.add.at(a, (at_row[keep_l], np.searchsorted(inner, left["k"].to_numpy()[keep_l])), left["a"].to_numpy()[keep_l])
        at_inner = np.searchsorted(inner, right["k"].to_numpy()[keep_r])
        products = []
        met = np.zeros((len(inner), len(cols)))
        met[at_inner, at_col[keep_r]] = 1.0
        for v in values:
            b = np.zeros((len(inner), len(cols)))
            np.add.at(b, (at_inner, at_col[keep_r]), right[v].to_numpy()[keep_r])
            products.append(a @ b)
        known = ((a != 0).astype(float) @ met) > 0
        if asked is None:
            i, j = np.nonzero(known)
        else:
            take = asked["i"].isin(rows).to_numpy() & asked["j"].isin(cols).to_numpy()
            i = np.searchsorted(rows, asked["i"].to_numpy()[take].astype(rows.dtype))
            j = np.searchsorted(cols, asked["j"].to_numpy()[take].astype(cols.dtype))
            i, j = i[known[i, j]], j[known[i, j]]
        return pd.DataFrame({"i": rows[i], "j": cols[j], **{v: p[i, j] for v, p in zip(values, products)}})

    return cell


def block_product(
    left: DataFrame, right: DataFrame, values: Sequence[str] = ("b",), *, block_rows: int = 1024, chunk: int = 2048,
    only: DataFrame | None = None,
) -> DataFrame:
    """``left(i, k, a)`` times ``right(k, j, <values>)``: ``i, j`` and one sum per value column.

    Pairs that meet no common ``k`` with a non-zero ``a`` do not appear. With ``only(i, j)`` the others than
    those do not leave their task either.
    """
    sizes_l = left.agg(F.approx_count_distinct("i").alias("i"), F.approx_count_distinct("k").alias("k"), F.min("i").alias("some")).first()
    sizes_r = right.agg(F.approx_count_distinct("j").alias("j"), F.min("k").alias("some")).first()
    size_j = sizes_r["j"]
    n_i, n_j, n_k = (
        max(1, math.ceil(n / size)) for n, size in ((sizes_l["i"], block_rows), (size_j, block_rows), (sizes_l["k"], chunk))
    )

    def block(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    a = left.select(
        "i", "k", F.col("a").cast("double").alias("a"), block("i", n_i).alias("bi"), block("k", n_k).alias("bk"), every(n_j).alias("bj")
    )
    b = right.select(
        "k", "j", *[F.col(v).cast("double").alias(v) for v in values],
        block("j", n_j).alias("bj"), block("k", n_k).alias("bk"), every(n_i).alias("bi"),
    )
    if only is not None:
        wanted = only.select("i", "j").filter("i IS NOT NULL AND j IS NOT NULL").distinct().select(
            "i", "j", F.lit(True).alias("asked"), block("i", n_i).alias("bi"), block("j", n_j).alias("bj"), every(n_k).alias("bk")
        )
        # Any index stands where a line has none, since pandas would turn the others into floats.
        some_i, some_k = F.lit(sizes_l["some"]).cast(left.schema["i"].dataType), F.lit(sizes_r["some"]).cast(right.schema["k"].dataType)
        nothing = {v: F.lit(0.0) for v in values} | {"k": some_k}
        b = b.withColumn("asked", F.lit(False)).withColumn("i", some_i).unionByName(wanted.withColumns(nothing))
    types = f"i {left.schema['i'].dataType.simpleString()}, j {right.schema['j'].dataType.simpleString()}, "
    partial = (
        a.groupBy("bi", "bj", "bk").cogroup(b.groupBy("bi", "bj", "bk"))
        .applyInPandas(_block_product(list(values)), types + ", ".join(f"{v} double" for v in values))
    )
    if n_k == 1:
        return partial
    return partial.groupBy("i", "j").agg(*[F.sum(v).alias(v) for v in values])
