"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error", columns: Sequence[str] | None = None) -> None:
    """Save all or some columns; Parquet unless told otherwise."""
    out = df.select(*columns) if columns else df
    out.write.format(fmt).mode(mode).save(path)


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    """A managed table, or an external one when a path is given."""
    writer = df.write.mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def save_partitioned(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """One folder per key, Parquet."""
    df.write.mode(mode).partitionBy(column).parquet(path)


def save_csv_by(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """One folder per key, CSV with a header; arrays are joined with commas first."""
    flat = df.select(
        *[
            F.concat_ws(",", c).alias(c) if t.startswith("array") else F.col(c)
            for c, t in df.dtypes
        ]
    )
    flat.write.mode(mode).partitionBy(column).option("header", True).csv(path)


def save_documents(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Each row as one JSON document per line."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode(mode).text(path)


def save_topn(df: DataFrame, path: str, n: int, user: str = "user_id", item: str = "item_id", rank: str = "rank", mode: str = "overwrite") -> None:
    """One line per user: the user and the first ``n`` ids by rank, joined by blanks.

    The rank filter comes first, so a list never holds more than ``n`` ids.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank), F.col(item))))
    lists = (
        df.filter(F.col(rank) <= n)
        .groupBy(user)
        .agg(F.concat_ws(" ", F.transform(pairs, lambda p: p[item].cast("string"))).alias("prediction"))
    )
    lists.select(F.col(user).alias("user_id"), "prediction").write.mode(mode).option("header", True).csv(path)


def save_model(model: Model, path: str) -> None:
    """Save a fitted pipeline, replacing an older one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Reload a fitted pipeline."""
    return PipelineModel.load(path)
