"""Global and per-key row numbers and running sums without a one-task window.

A window without keys, or with one hot key, sorts everything in a single task. Here the
rows are range-sorted across tasks first; each task numbers its own rows and adds the
totals of the tasks before it. Only one row per task is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.plans.runs import numbered
from tabloom.plans.storage import written


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the most frequent key combination (counted with map-side combine)."""
    row = df.groupBy(*keys).count().agg(F.max("count").alias("n")).first()
    return row["n"] or 0


def with_position(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "pos",
    running: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the 1-based global position under ``order`` and inclusive running sums.

    ``order`` must end in a unique column so that positions are reproducible; the range
    sort can then also split a long run of equal leading values over several tasks.
    """
    running = running or {}
    staged = df.select("*", *[c.alias(f"_v_{k}") for k, c in running.items()])
    staged = staged.orderBy(*[_column(c) for c in order])
    staged = written(staged.withColumn("_mid", F.monotonically_increasing_id()), "sorted")
    staged = staged.withColumn("_task", F.shiftright("_mid", 33)).withColumn(
        "_offset", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )

    totals = staged.groupBy("_task").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in running]
    )
    # One row per sort task: small by construction.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "_task",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"),
        *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in running],
    )
    joined = staged.join(F.broadcast(bases), "_task")
    inside = Window.partitionBy("_task").orderBy("_offset").rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *df.columns,
        (F.col("_base") + F.col("_offset") + 1).alias(name),
        *[(F.col(f"_b_{k}") + F.sum(f"_v_{k}").over(inside)).alias(k) for k in running],
    )


def _by_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on the keys, null matching null as in a window; only the left copies of the keys stay."""
    named = right.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    return left.join(named, same).drop(*[f"_key_{i}" for i in range(len(keys))])


def row_number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str = "rn",
    hot_rows: int | None = None,
) -> DataFrame:
    """``row_number`` per key by one range sort, in one way for all sizes of keys (see ``numbered``).

    ``hot_rows`` is accepted from earlier callers and chooses nothing.
    """
    return numbered(df, keys, order, name)


def exact_percentiles(df: DataFrame, column: str, fractions: Sequence[float]) -> list[float]:
    """Exact percentiles with linear interpolation between neighbouring ranks.

    Equal values are counted first; the distinct values are placed by a distributed sort with
    a running count, and only the rows at the wanted ranks are read back.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    placed = with_position(counts, ["v"], "_pos", {"upto": F.col("n")})
    total = placed.agg(F.max("upto")).first()[0]
    if not total:
        return [float("nan")] * len(fractions)
    ranks = [(total - 1) * f for f in fractions]
    wanted = sorted({int(r) for r in ranks} | {min(int(r) + 1, total - 1) for r in ranks})
    at = F.array(*[F.lit(w).cast("long") for w in wanted])
    hit = placed.withColumn("k", F.explode(F.filter(at, lambda w: (w < F.col("upto")) & (w >= F.col("upto") - F.col("n")))))
    value = {r["k"]: r["v"] for r in hit.select("k", "v").collect()}
    return [
        value[int(r)] + (r - int(r)) * (value[min(int(r) + 1, total - 1)] - value[int(r)]) for r in ranks
    ]


def percentile_within(
    df: DataFrame, keys: Sequence[str], column: str, fraction: float, name: str = "percentile", hot_rows: int | None = None
) -> DataFrame:
    """Exact percentile per key, linear between neighbouring ranks, in one way for all sizes of keys.

    Values are counted per key first, a distributed sort sums the counts along each key, and only sums,
    minima and maxima are taken per key. ``hot_rows`` is accepted from earlier callers and chooses nothing.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, F.col(column).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    placed = numbered(counts, keys, ["_v"], "_pos", {"_upto": F.col("_n")})
    bounds = placed.groupBy(*keys).agg(F.lit(0).cast("long").alias("_start"), F.max("_upto").alias("_end"))
    ranked = _by_keys(placed, bounds, keys).withColumn("_h", (F.col("_end") - F.col("_start") - 1) * F.lit(fraction))
    upto = F.col("_upto") - F.col("_start")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < upto) & (rank >= upto - F.col("_n")), F.col("_v")))

    ends = ranked.groupBy(*keys).agg(
        at(F.floor("_h")).alias("_a"), at(F.ceil("_h")).alias("_b"), F.max(F.col("_h") - F.floor("_h")).alias("_part")
    )
    return ends.select(*keys, (F.col("_a") + F.col("_part") * (F.col("_b") - F.col("_a"))).alias(name))
