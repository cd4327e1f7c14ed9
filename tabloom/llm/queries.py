"""The registered queries of this package, one thin query for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import bpe, dedup, jaccard, main_text, neighbours, packing, pii, quality, secret_scan, toxicity, trie, urls, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(table(spark, sf, "documents"), vocabulary), vocabulary)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: The key of the pseudonyms in the registered query; a real job passes a secret of its own.
PSEUDONYM_KEY = "tabloom"


@query
def op4_pii_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    masked = pii.mask(table(spark, sf, "documents"), PSEUDONYM_KEY)
    return masked.select("doc_id", "text", F.size("private").cast("long").alias("n_private"), F.col("private.kind").alias("kinds"), F.col("private.value").alias("found"), F.col("private.pseudonym").alias("pseudonyms"))


#: The rules of the registered query.
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


@query
def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"), URL_RULES)


@query
def op10_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.exact_groups(table(spark, sf, "documents"))


ORACLES["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


#: Scores from here on are predicted toxic.
TOXIC_FROM = 0.3


@query
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "hits"
    )


@query
def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = secret_scan.find(docs, secret_scan.fit(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = joined(F.filter("spans", lambda s: s["kind"] != "crf"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), count("crf"),
    )


@query
def op2_html_main_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    texts = main_text.extract(pages, main_text.fit(pages))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op9_nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_bm25_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_classes(table(spark, sf, "documents"))


#: Scores from here on are predicted good.
GOOD_FROM = 0.3


@query
def op12_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality.fit(docs, table(spark, sf, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")
    )


@query
def op13_lanczos_whitening(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    model = whitening.fit(vectors)
    long = whitening.transform(vectors, model).select("vec_id", F.col("deviation").cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*(F.lit(e) for e in model.explained)).cast("array<double>")
    return long.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )


@query
def op11_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    conv = F.col("conv")
    turns, convs = trie.share_heads(trie.ordered_turns(table(spark, sf, "conversations")), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, 3)
    nodes = trie.prefix_trie(turns, convs)
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"),
        F.col("enter").alias("enter_at"), F.col("leave").alias("leave_at"),
    )


#: The unsigned CRC-32 of the decimal digits of c, bit by bit: each byte goes in, then eight shifts.
_CRC = """xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i::INTEGER, 1))::BIGINT)),
      lambda state, byte: list_reduce([xor(state, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, shift: xor(x >> 1, (x & 1) * 3988292384))))"""

ORACLES["op11_conversation_trie"] = f"""
WITH turns AS (
  SELECT conv_id AS c, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, {_CRC} % 4 AS h, c - c % 20 AS base FROM (SELECT DISTINCT c FROM turns)),
parts AS (
  SELECT convs.c, 0 AS own, pos, digest, words FROM convs JOIN turns ON turns.c = base AND pos <= h
  UNION ALL SELECT c, 1, pos, digest, words FROM turns JOIN convs USING (c) WHERE pos > h),
rebuilt AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, digest, words FROM parts),
prefixes AS (
  SELECT c, d, words, string_agg(digest, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS name FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
sizes AS (SELECT c, max(d) AS size FROM prefixes GROUP BY c),
members AS (SELECT c, d, min(c) OVER same AS node, words, size FROM prefixes JOIN sizes USING (c) WINDOW same AS (PARTITION BY d, name)),
nodes AS (
  SELECT node, d, count(*) AS n, any_value(words) AS words,
    coalesce(string_agg(CASE WHEN size = d THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends
  FROM members GROUP BY node, d),
ups AS (SELECT nodes.node, nodes.d, above.node AS parent FROM nodes LEFT JOIN members above ON above.c = nodes.node AND above.d = nodes.d - 1),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS kids FROM ups WHERE parent IS NOT NULL GROUP BY ALL),
below AS (
  SELECT above.node, above.d, sum((kids IS NULL)::BIGINT) AS leaves, sum((n - 1) * nodes.words) AS saved
  FROM nodes LEFT JOIN kids USING (node, d) JOIN members above ON above.c = nodes.node AND above.d <= nodes.d
  GROUP BY above.node, above.d),
tour AS (  -- arcs in order: the path of smallest members from the root, with a mark behind all at the end
  SELECT nodes.node, nodes.d, list(above.node ORDER BY above.d) AS path FROM nodes JOIN members above ON above.c = nodes.node AND above.d <= nodes.d GROUP BY nodes.node, nodes.d),
arcs AS (
  SELECT node, d, true AS enters, path AS place FROM tour UNION ALL SELECT node, d, false, list_append(path, 9223372036854775807) FROM tour),
places AS (SELECT node, d, enters, row_number() OVER (ORDER BY place) - 1 AS at FROM arcs)
SELECT node AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, coalesce(kids, 0) AS n_children, leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256, e.at AS enter_at, l.at AS leave_at
FROM nodes JOIN ups USING (node, d) LEFT JOIN kids USING (node, d) JOIN below USING (node, d)
JOIN places e ON e.node = nodes.node AND e.d = nodes.d AND e.enters JOIN places l ON l.node = nodes.node AND l.d = nodes.d AND NOT l.enters
"""
