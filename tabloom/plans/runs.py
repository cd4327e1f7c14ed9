"""Row numbers and running sums within keys, through one range sort, however hot a key is.

The rows are sorted by key and order over all tasks; the sort may cut through a key. Each task numbers
its rows in one streaming pass, and what a cut key had in the tasks before comes from one row a task.
There is one way for all sizes: no window ever holds a key, and nothing looks for hot keys first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from tabloom.plans.storage import written


def _differs(column: pa.Array) -> np.ndarray:
    """Whether each entry but the first differs from the one before; nulls equal nulls, NaN equals NaN."""
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    same = pc.fill_null(pc.equal(a, b), False)
    same = pc.or_(same, pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(column.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return ~same.to_numpy(zero_copy_only=False)


def run_starts(columns: Sequence[pa.Array], before: Sequence[pa.Array] | None) -> np.ndarray:
    """Where a run of equal keys starts. ``before`` has the keys of the row before, None if there is none."""
    changed = np.zeros(len(columns[0]), dtype=bool)
    for i, column in enumerate(columns):
        if before is not None:
            changed |= _differs(pa.concat_arrays([before[i], column]))
        else:
            changed[1:] |= _differs(column)
    if before is None:
        changed[0] = True
    return changed


def _local(n_keys: int, n_sums: int, schema: pa.Schema):
    """The streaming pass: number, sums, task, whether in the task's first run, and 1 at the first and 2 at the last row."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        before, held, first = None, None, True
        carry, carried = 0, [0] * n_sums
        for part in parts:
            rows = part.num_rows
            if not rows:
                continue
            keys = [part.column(i) for i in range(n_keys)]
            at = np.arange(rows)
            starts = run_starts(keys, before)
            at_start = np.maximum.accumulate(np.where(starts, at, -1))
            inside = at_start >= 0
            number = at - at_start + np.where(inside, 1, carry)
            sums = []
            for j in range(n_sums):
                values = pc.fill_null(part.column(n_keys + j), 0).to_numpy(zero_copy_only=False)
                total = np.cumsum(values)
                kept = np.where(inside, -(total - values)[np.maximum(at_start, 0)], carried[j])
                sums.append(total + kept)
                carried[j] = sums[-1][-1]
            in_first = np.zeros(rows, dtype=bool) if not first else np.cumsum(starts) <= (0 if before is not None else 1)
            first = bool(in_first[-1])
            edge = np.zeros(rows, dtype=np.int32)
            if held is None and before is None:
                edge[0] = 1
            carry, before = int(number[-1]), [k.slice(rows - 1) for k in keys]
            if held is not None:
                yield held
            columns = [*part.columns[: n_keys], *part.columns[n_keys + n_sums :], number, *sums, np.full(rows, task, np.int32), in_first, edge]
            held = pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c).cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )
        if held is not None:
            edge = held.column(held.num_columns - 1).to_numpy().copy()
            edge[-1] += 2
            yield held.set_column(held.num_columns - 1, schema.field(held.num_columns - 1), pa.array(edge))

    return work


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rn", sums: dict[str, Column] | None = None
) -> DataFrame:
    """Add the 1-based number of each row within its keys, and running sums (inclusive, null as 0).

    ``order`` must end in a unique column, or the numbers of equal rows are not reproducible. Nulls are a key
    like any other. The result is a stored table, so it can be read many times.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    sums = sums or {}
    rest = [c for c in df.columns if c not in keys]
    key_names = [f"_k{i}" for i in range(len(keys))]
    staged = df.orderBy(*keys, *order).select(
        *(F.col(k).alias(n) for k, n in zip(keys, key_names, strict=True)), *(c.alias(f"_s{i}") for i, c in enumerate(sums.values())),
        *(F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)),
    )
    kinds = staged.schema
    total = [StructField(f"_t{i}", kinds[f"_s{i}"].dataType) for i in range(len(sums))]
    fields = [*(f for f in kinds if not f.name.startswith("_s")), StructField("_n", LongType()), *total]
    fields += [StructField("_task", IntegerType()), StructField("_in_first", BooleanType()), StructField("_edge", IntegerType())]
    out = StructType([StructField(f.name, f.dataType, True) for f in fields])
    placed = written(staged.mapInArrow(_local(len(keys), len(sums), to_arrow_schema(out)), out), "runs")

    # One row a task: what of its first key lies in the tasks before.
    counts = ["_n", *(f.name for f in total)]
    edge = F.struct(*key_names, *counts, "_in_first")
    last = placed.filter("_edge >= 2").select("_task", edge.alias("last"))
    first = placed.filter("_edge % 2 = 1").select("_task", F.struct(*key_names).alias("first"))
    tasks, every = last.join(first, "_task"), Window.orderBy("_task")
    same = F.lit(True)
    for k in key_names:
        same = same & F.col(f"first.{k}").eqNullSafe(F.lag(F.col(f"last.{k}")).over(every))
    tasks = tasks.withColumn("_same", same & F.lag(F.lit(True), 1, False).over(every))
    tasks = tasks.withColumn("_island", F.sum((~(F.col("_same") & F.col("last._in_first"))).cast("int")).over(every))
    upto = Window.partitionBy("_island").orderBy("_task")
    tasks = tasks.select("_task", "_same", *(F.sum(F.col(f"last.{c}")).over(upto).alias(f"_upto{c}") for c in counts))
    tasks = tasks.select(
        "_task", F.lit(True).alias("_in_first"),
        *(F.when(F.col("_same"), F.lag(f"_upto{c}").over(every)).otherwise(F.lit(0)).alias(f"_before{c}") for c in counts),
    )
    joined = placed.join(F.broadcast(tasks), ["_task", "_in_first"], "left")  # a row a task
    back = {k: F.col(n).alias(k) for k, n in zip(keys, key_names, strict=True)} | {c: F.col(f"_r{i}").alias(c) for i, c in enumerate(rest)}
    plus = lambda c, kind: (F.col(c) + F.coalesce(F.col(f"_before{c}"), F.lit(0))).cast(kind)
    return joined.select(
        *(back[c] for c in df.columns), plus("_n", "long").alias(name), *(plus(f"_t{i}", total[i].dataType).alias(s) for i, s in enumerate(sums))
    )

