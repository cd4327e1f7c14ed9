"""User functions and the lifecycle verbs of a table.

A built-in expression is always the better choice; these exist because users bring functions
of their own. Batches travel as Arrow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register(spark: SparkSession, name: str, fn: Callable, kind=None):
    """Make ``fn`` callable from SQL. Without a type the result is a string."""
    wrapped = F.udf(fn, kind or "string", useArrow=True)
    return spark.udf.register(name, wrapped)


def column_udf(fn: Callable, kind):
    """``fn`` for the DataFrame API."""
    return F.udf(fn, kind, useArrow=True)


def combine_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): the distinct values of each key, one row each, so no key fills a task."""
    return df.select(key, value).distinct()


def _plain(column: pd.Series) -> list:
    """Python's own values, with None for what is missing."""
    missing = column.isna()
    values = column.tolist()
    return [None if gone and pd.api.types.is_scalar(v) else v for v, gone in zip(values, missing, strict=True)] if missing.any() else values


def _batches(items: Iterator, size: int = 1024) -> Iterator[list]:
    while some := list(islice(items, size)):
        yield some


def aggregate_by_key(
    df: DataFrame, key: str, value: str, create: Callable, merge_value: Callable, merge: Callable, kind: str,
    finish: Callable | None = None, keys_at_once: int = 100_000, fan: int = 32,
) -> DataFrame:
    """(key, value): a user's aggregate made of three functions, with partial results on the map side.

    ``create(value)`` starts a combiner, ``merge_value(combiner, value)`` takes in one more value, and
    ``merge(a, b)`` joins two combiners; ``finish`` turns a combiner into the result of type ``kind``. Every
    task keeps at most ``keys_at_once`` combiners and hands on those it has when more come. The combiners of
    a key, one or a few from each task, are joined ``fan`` at a time over two levels, so a hot key is joined by
    many tasks; each level streams through its keys in order, so many keys cost no call of Spark's each. A function
    may change and return its first argument. The functions see nulls like any value; a null key is a key. Values are joined in no set order.
    """
    kind_of_key = df.schema[key].dataType.simpleString()

    def handed_on(held: Iterable[tuple]) -> pd.DataFrame:
        keys, combiners = zip(*held, strict=True)
        return pd.DataFrame({"k": pd.Series(keys, dtype=object), "c": [cloudpickle.dumps(c) for c in combiners]})

    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for part in parts:
            for k, v in zip(*(_plain(part[c]) for c in part.columns), strict=True):
                held[k] = merge_value(held[k], v) if k in held else create(v)
                if len(held) >= keys_at_once:
                    yield handed_on(held.items())
                    held = {}
        if held:
            yield handed_on(held.items())

    def joined(parts: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """Each key of a sorted stream with its combiners joined; a key may go on in the next batch."""
        before: list = []
        for part in parts:
            for k, c in zip(_plain(part["k"]), part["c"], strict=True):
                c = cloudpickle.loads(c)
                if before and before[0] == k:
                    before[1] = merge(before[1], c)
                    continue
                if before:
                    yield tuple(before)
                before = [k, c]
        if before:
            yield tuple(before)

    def level(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _batches(joined(parts)):
            yield handed_on(some)

    def last(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _batches(joined(parts)):
            totals = [finish(c) if finish else c for _, c in some]
            yield pd.DataFrame({key: pd.Series([k for k, _ in some], dtype=object), value: pd.Series(totals, dtype=object)})

    partials = f"k {kind_of_key}, c binary"
    rows = df.select(key, value).mapInPandas(partial, partials).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(fan)))
    rows = rows.repartition("k", "_salt").sortWithinPartitions("k", "_salt").select("k", "c").mapInPandas(level, partials)
    rows = rows.repartition("k").sortWithinPartitions("k")
    return rows.mapInPandas(last, f"`{key}` {kind_of_key}, `{value}` {kind}")


def cache(df: DataFrame) -> DataFrame:
    """Keep in memory, spilling to disk."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def release(df: DataFrame) -> DataFrame:
    return df.unpersist()


def cache_state(df: DataFrame) -> dict:
    """Whether the table is cached, and where."""
    return {"cached": df.is_cached, "level": str(df.storageLevel)}


def partitions(df: DataFrame) -> DataFrame:
    """(partition, n): rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def fewer_partitions(df: DataFrame, n: int) -> DataFrame:
    return df.coalesce(n)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan that ``explain`` prints."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
