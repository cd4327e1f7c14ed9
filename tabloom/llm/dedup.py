"""Exact duplicates by skew-safe combining, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import text_of
from tabloom.plans.storage import written


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = 64, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """For every row: ``key``, ``keep_id`` (largest key of its equal texts), ``group_size``, ``kept``, ``text_sha256``.

    1. Each input partition combines its equal texts before anything moves (the salt follows the
       partition, so the aggregation's map side sees all of them).
    2. Salted digest groups merge: one hot text meets in as many tasks as there are salts.
    3. The salt winners, one row for each text and salt, are combined for each digest and text.

    The text itself is a grouping key each time, so equal digests never merge different texts.
    Null texts count as empty. Rows that repeat a key share its verdict; a group whose keys are all
    null keeps null. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("id"), text_of(text).alias("body")).withColumn("digest", digest(F.col("body")))
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    winners = salted.groupBy("digest", "salt", "body").agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n"))
    best = winners.groupBy("digest", "body").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
    best = written(best.select("digest", "keep_id", "group_size", F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256")), "exact-groups")
    clash = best.groupBy("digest").count().filter("count > 1").select("digest")
    out = rows.select("id", "digest").join(best, "digest")
    if not clash.isEmpty():  # texts of equal digest, told apart by a second digest
        out = (
            rows.withColumn("text_sha256", F.sha2(F.col("body").cast("binary"), 256)).select("id", "digest", "text_sha256")
            .join(best, ["digest", "text_sha256"])
        )
    return out.select(
        F.col("id").alias(key), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = 64) -> DataFrame:
    """One whole row for each text, that with the largest key, by the same three stages; null texts equal empty ones.

    Among rows that repeat the key, any one stays. Other columns may have any names.
    """
    others = F.struct(F.col(text).isNull().alias("null"), F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text)).alias("rest"))
    rows = docs.select(text_of(text).alias("_body"), others.alias("_row"), F.struct(F.col(key).isNotNull().alias("known"), F.col(key).alias("id")).alias("_order"))
    rows = rows.withColumn("_digest", sha256(F.col("_body"))).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    best = [F.max_by("_row", "_order").alias("_row"), F.max("_order").alias("_order")]
    rows = rows.groupBy("_digest", "_salt", "_body").agg(*best).groupBy("_digest", "_body").agg(*best)
    body = F.when(~F.col("_row.null"), F.col("_body")).alias(text)
    return rows.select(*(body if c == text else F.col(f"_row.rest.c{i}").alias(c) for i, c in enumerate(docs.columns)))
