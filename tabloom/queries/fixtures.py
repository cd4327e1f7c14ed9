"""Stand-in inputs built from the given tables, once for Spark and once as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.queries.registry import table

#: The years that the given orders span.
ORDER_YEARS = list(range(1995, 2002))

# --- server log lines -------------------------------------------------------------------


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(event_id, line): common log format with broken lines, ``-`` sizes, trailing blanks."""
    return table(spark, sf, "events").selectExpr(
        "event_id",
        """CASE WHEN event_id % 97 = 0 THEN concat('broken line ', CAST(event_id AS STRING))
           ELSE concat('host', CAST(user_id AS STRING), '.example.com - - [',
             date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'),
             ' -0400] "GET /p/', CAST(event_id % 40 AS STRING), ' HTTP/1.0',
             CASE WHEN event_id % 50 = 0 THEN ' ' ELSE '' END, '" ',
             CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN '404' ELSE '500' END
                             WHEN 'signup' THEN '302' ELSE '200' END, ' ',
             CASE WHEN event_id % 7 = 0 THEN '-'
                  ELSE CAST(CAST(round(value * 100) AS BIGINT) AS STRING) END) END AS line""",
    )


# The fields the parser must find, stated from the events themselves.
LOG_SQL = """logs AS (SELECT event_id, 'host' || user_id || '.example.com' AS host,
    date_trunc('second', ts) AS date_time, '/p/' || (event_id % 40) AS endpoint,
    CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 404 ELSE 500 END
                    WHEN 'signup' THEN 302 ELSE 200 END AS response_code,
    CASE WHEN event_id % 7 = 0 THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS content_size
  FROM events WHERE event_id % 97 <> 0)"""


# --- social posts -----------------------------------------------------------------------


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """Posts that repeat per id, with a nested user, a tag array and a source link."""
    return table(spark, sf, "events").selectExpr(
        "event_id % 2000 AS id",
        "named_struct('id_str', CAST(user_id AS STRING), 'followers_count', user_id * 3) AS user",
        "concat('NATION_', user_id % 25) AS location",
        "CAST(round(value * 10) AS INT) AS retweet_count",
        "array(event_type, concat('k', user_id % 10)) AS hashtags",
        "concat('<a href=\"u\" rel=\"n\">', event_type, '</a>') AS source",
    )


POSTS_SQL = """posts AS (SELECT event_id % 2000 AS id, CAST(user_id AS VARCHAR) AS user_id_str,
    user_id * 3 AS user_followers_count, 'NATION_' || (user_id % 25) AS location,
    CAST(round(value * 10) AS INTEGER) AS retweet_count,
    [event_type, 'k' || (user_id % 10)] AS hashtags, event_type AS source FROM events)"""


# --- ratings ----------------------------------------------------------------------------


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """(user_id, item_id, rating 1-5, ts), one row per pair."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), (F.col("l_partkey") % 200).alias("item_id"))
        .agg(
            F.max(1 + F.col("l_quantity").cast("int") % 5).alias("rating"),
            F.max("o_orderdate").alias("ts"),
        )
    )


RATINGS_SQL = """ratings AS (SELECT o_custkey AS user_id, l_partkey % 200 AS item_id,
    max(1 + CAST(l_quantity AS INTEGER) % 5) AS rating, max(o_orderdate) AS ts
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)"""


def movies(spark: SparkSession, sf: str) -> DataFrame:
    """(item_id, title with a year in brackets, genres joined by ``|``)."""
    part = table(spark, sf, "part").withColumn("item_id", F.col("p_partkey") % 200)
    return part.groupBy("item_id").agg(
        F.concat(
            F.min("p_name"), F.lit(" ("), (F.lit(1950) + F.col("item_id") % 60).cast("string"), F.lit(")")
        ).alias("title"),
        F.array_join(
            F.array_sort(
                F.array_union(F.collect_set("p_type"), F.collect_set(F.concat(F.lit("S"), (F.col("p_size") % 3).cast("string"))))
            ),
            "|",
        ).alias("genres"),
    )


MOVIES_SQL = """movies AS (SELECT p_partkey % 200 AS item_id,
    min(p_name) || ' (' || (1950 + p_partkey % 200 % 60) || ')' AS title,
    array_to_string(list_sort(list_distinct(list_concat(list(DISTINCT p_type),
      list(DISTINCT 'S' || (p_size % 3))))), '|') AS genres
  FROM part GROUP BY p_partkey % 200)"""


def users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS user_id",
        "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
        "c_mktsegment AS occupation",
    )


USERS_SQL = """users AS (SELECT c_custkey AS user_id, c_mktsegment AS occupation,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender FROM customer)"""


# --- baskets ----------------------------------------------------------------------------


def basket_items(spark: SparkSession, sf: str) -> DataFrame:
    """(basket, item): distinct brands per order."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item"))
        .distinct()
    )


BASKETS_SQL = """baskets AS (SELECT DISTINCT l_orderkey AS basket, p_brand AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


# --- labelled scores, points, edges, series -----------------------------------------------


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, score, label, grp): text length as a score with ties, quality as outcome."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("score"), F.col("quality").alias("label"), F.col("lang").alias("grp")
    )


SCORED_SQL = """scored AS (SELECT d.doc_id, CAST(n_chars AS DOUBLE) AS score, quality AS label, lang AS grp
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def points(spark: SparkSession, sf: str) -> DataFrame:
    """(id, x, y): the first two dimensions of the embeddings."""
    return table(spark, sf, "embeddings").selectExpr(
        "vec_id AS id", "CAST(embedding[0] AS DOUBLE) AS x", "CAST(embedding[1] AS DOUBLE) AS y"
    )


POINTS_SQL = """points AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x,
    CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(id, vec array<double>, label)."""
    return table(spark, sf, "embeddings").selectExpr(
        "vec_id AS id", "CAST(embedding AS ARRAY<DOUBLE>) AS vec", "label"
    )


VECTORS_SQL = """vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"""

# Long form (id, dim from 0, value) of the vectors.
ENTRIES_SQL = """entries AS (SELECT vec_id AS id, unnest(range(len(embedding))) AS dim,
    CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"""


def entries(spark: SparkSession, sf: str) -> DataFrame:
    return vectors(spark, sf).select("id", F.posexplode("vec").alias("dim", "value"))


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (user, user of the next event); users ending in 0 have no out-edge."""
    events = table(spark, sf, "events")
    here = events.select("event_id", F.col("user_id").alias("src"))
    following = events.select((F.col("event_id") - 1).alias("event_id"), F.col("user_id").alias("dst"))
    return (
        here.join(following, "event_id")
        .filter((F.col("src") != F.col("dst")) & (F.col("src") % 10 != 0))
        .select("src", "dst")
        .distinct()
    )


EDGES_SQL = """edges AS (SELECT DISTINCT a.user_id AS src, b.user_id AS dst
  FROM events a JOIN events b ON a.event_id = b.event_id - 1
  WHERE a.user_id <> b.user_id AND a.user_id % 10 <> 0)"""


def series(spark: SparkSession, sf: str) -> DataFrame:
    """(series, t, id, value): the event values of each type in time order."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("series"), F.col("ts").alias("t"), F.col("event_id").alias("id"), "value"
    )


SERIES_SQL = """series AS (SELECT event_type AS series, event_id AS id, value,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS t FROM events)"""


def job_ads(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as ads: text fields, some null or empty, a location and a yes/no label."""
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS id",
        """CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN ''
           ELSE concat('C', c_nationkey, ',', CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('S', c_custkey % 9) END,
             CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat(',', c_name) END) END AS location""",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS department",
        "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal END AS salary",
        "CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_name END AS title",
        "CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS fraudulent",
    )


JOBS_SQL = """jobs AS (SELECT c_custkey AS id,
    CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN ''
      ELSE 'C' || c_nationkey || ',' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'S' || (c_custkey % 9) END
        || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ',' || c_name END END AS location,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS department,
    CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal END AS salary,
    CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_name END AS title,
    CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS fraudulent FROM customer)"""
