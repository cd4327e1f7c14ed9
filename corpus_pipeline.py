"""The corpus pipeline: toxic texts, copies and near copies go, secrets are masked, the rest is packed.

Every stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns the
columns of ``documents``, but for the last, which returns the packed pieces. ``run`` writes the result
of each stage as Parquet below ``spark.checkpoint.dir`` and reads it back.

Null texts count as empty and stay null; empty texts are clean, equal to each other, and near to
nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import dedup, jaccard, packing, secret_scan, toxicity
from tabloom.plans.storage import written

#: Texts that score so much go.
TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model, TOXIC_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each class stays. A row without an id has no class, and stays."""
    classes = jaccard.near_classes(docs)
    gone = classes.filter("doc_id <> component_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.redact(docs, secret_scan.fit(docs))
    return masked.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: Learned scores, a fitted tagger and a tokenizer have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
