"""Scaling, encodings, text features, balance."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.functions import text
from tabloom.operators import features as feat
from tabloom.operators.aggregates import word_count
from tabloom.plans import spread, with_position
from tabloom.queries import fixtures as fx
from tabloom.queries.registry import query, table
from tabloom.queries.rows import STOPS_SQL

def rounded(df, keys, columns, digits=6):
    return df.select(*keys, *[F.round(c, digits).alias(c) for c in columns])


@query(
    "e01_standard_scale_population",
    "SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal FROM customer",
)
def e01(spark, sf):
    df = table(spark, sf, "customer")
    return rounded(feat.apply_scaling(df, feat.fit_standard(df, ["c_acctbal"])), ["c_custkey"], ["c_acctbal"])


@query(
    "e02_standard_scale_sample",
    "SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_samp(c_acctbal) FROM customer), 6) AS c_acctbal FROM customer",
)
def e02(spark, sf):
    df = table(spark, sf, "customer")
    return rounded(feat.apply_scaling(df, feat.fit_standard(df, ["c_acctbal"], ddof=1)), ["c_custkey"], ["c_acctbal"])


@query(
    "e03_minmax_scale",
    """WITH t AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders WHERE o_orderstatus <> 'P')
    SELECT o_orderkey, round((o_totalprice - a) / (b - a), 6) AS o_totalprice FROM orders, t""",
)
def e03(spark, sf):
    df = table(spark, sf, "orders")
    scaling = feat.fit_minmax(df.filter("o_orderstatus <> 'P'"), ["o_totalprice"])
    return rounded(feat.apply_scaling(df, scaling), ["o_orderkey"], ["o_totalprice"])


@query(
    "e04_percentile_scale",
    """WITH t AS (SELECT quantile_cont(o_totalprice, 0.05) AS a, quantile_cont(o_totalprice, 0.95) AS b FROM orders)
    SELECT o_orderkey, round((o_totalprice - a) / (b - a), 6) AS o_totalprice FROM orders, t""",
)
def e04(spark, sf):
    df = table(spark, sf, "orders")
    return rounded(feat.apply_scaling(df, feat.fit_percentile(df, ["o_totalprice"], 5.0)), ["o_orderkey"], ["o_totalprice"])


@query(
    "e05_index_strings",
    """WITH c AS (SELECT p_name, row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS by_count,
      row_number() OVER (ORDER BY p_name) - 1 AS by_name FROM part GROUP BY p_name)
    SELECT p_partkey, by_count, by_name FROM part JOIN c USING (p_name)""",
)
def e05(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    indexed = feat.index_strings(feat.index_strings(part, "p_name", "frequency", "by_count"), "p_name", "sorted", "by_name")
    return indexed.select("p_partkey", "by_count", "by_name")


@query(
    "e06_one_hot",
    """WITH c AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM part GROUP BY 1)
    SELECT code AS level, count(*) AS n FROM part JOIN c USING (p_brand) GROUP BY 1""",
)
def e06(spark, sf):
    indexed = feat.index_strings(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", "sorted", "brand")
    hot = feat.one_hot(indexed, ["brand"])
    levels = hot.select(F.posexplode(vector_to_array("brand_vec")).alias("level", "on"))
    return levels.groupBy(F.col("level").cast("long").alias("level")).agg(F.sum("on").cast("long").alias("n"))


@query(
    "e07_assemble_vector",
    "SELECT p_partkey, CAST(p_size AS DOUBLE) AS v0, p_retailprice AS v1 FROM part",
)
def e07(spark, sf):
    out = feat.assemble(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    parts = vector_to_array("features")
    return out.select("p_partkey", parts[0].alias("v0"), parts[1].alias("v1"))


WORDS_SQL = f"""w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
      lambda x: NOT list_contains({STOPS_SQL}, x)) AS t FROM documents)"""


@query(
    "e08_bag_of_words",
    f"WITH {WORDS_SQL} SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(t) AS term FROM w) GROUP BY 1, 2",
)
def e08(spark, sf):
    return feat.bag_of_words(table(spark, sf, "documents"), "doc_id", "text")


@query(
    "e09_hashing_tf",
    "SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS DOUBLE) AS n FROM documents",
)
def e09(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", text.words(F.col("text")).alias("tokens"))
    return feat.hashing_tf(docs, "tokens").select("doc_id", F.aggregate(
        vector_to_array("features"), F.lit(0.0), lambda a, v: a + v).alias("n"))


TFIDF_SQL = f"""{WORDS_SQL},
  g AS (SELECT doc_id, unnest(list_concat(t,
      list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]),
      list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]))) AS term FROM w),
  c AS (SELECT doc_id, term, count(*) AS n FROM g GROUP BY 1, 2),
  v AS (SELECT term, count(*) AS df FROM c GROUP BY 1 HAVING count(*) >= 0.05::DOUBLE * (SELECT count(*) FROM documents)),
  x AS (SELECT doc_id, term, n * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM c JOIN v USING (term)),
  tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM x)"""


@query("e10_tfidf", f"WITH {TFIDF_SQL} SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf")
def e10(spark, sf):
    out = feat.tfidf(table(spark, sf, "documents"), "doc_id", "text")
    return out.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query(
    "e11_polynomial_features",
    """SELECT id, round(x, 6) AS p0, round(x * x, 6) AS p1, round(y, 6) AS p2, round(x * y, 6) AS p3, round(y * y, 6) AS p4
    FROM (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)""",
)
def e11(spark, sf):
    out = feat.poly_expand(feat.assemble(fx.points(spark, sf), ["x", "y"]), "features", 2)
    parts = vector_to_array("poly")
    return out.select("id", *[F.round(parts[i], 6).alias(f"p{i}") for i in range(5)])


@query(
    "e12_fill_missing",
    f"""WITH {fx.JOBS_SQL} SELECT id, round(coalesce(salary, (SELECT avg(salary) FROM jobs)), 6) AS salary,
      coalesce(salary, 0) AS salary_zero FROM jobs""",
)
def e12(spark, sf):
    ads = fx.job_ads(spark, sf).select("id", "salary", F.coalesce("salary", F.lit(99.0)).alias("marked"), F.col("salary").alias("salary_zero"))
    filled = feat.fill_value(feat.fill_mean(ads, ["marked"], missing=99.0), ["salary_zero"])
    return filled.select("id", F.round("marked", 6).alias("salary"), "salary_zero")


@query("e13_noise_columns")
def e13(spark, sf):
    return feat.add_noise(table(spark, sf, "customer").select("c_custkey"), 4, 1)


@query(
    "e14_undersample",
    f"""WITH {fx.JOBS_SQL}, neg AS (SELECT id, row_number() OVER (ORDER BY id) AS pos FROM jobs WHERE fraudulent = 0),
    n AS (SELECT (SELECT count(*) FROM jobs WHERE fraudulent = 1) AS p, (SELECT count(*) FROM neg) AS q),
    draws AS (SELECT ('0x' || substr(md5('0|' || i), 1, 8))::BIGINT % q + 1 AS pos FROM n, range(p) t(i))
    SELECT id, 1 AS fraudulent FROM jobs WHERE fraudulent = 1 UNION ALL SELECT id, 0 FROM neg JOIN draws USING (pos)""",
)
def e14(spark, sf):
    return feat.undersample(fx.job_ads(spark, sf).select("id", "fraudulent"), "fraudulent", "id")


@query("e15_smote_tomek")
def e15(spark, sf):
    points = fx.vectors(spark, sf).select("id", "vec", (F.col("label") == 3).cast("int").alias("label"))
    return feat.smote_tomek(points).select("id", "label", F.size("vec").alias("size"))


@query(
    "f07_encode_genres",
    f"""WITH {fx.MOVIES_SQL}, v AS (SELECT item_id, unnest(string_split(lower(genres), '|')) AS g,
      unnest(range(len(string_split(genres, '|')))) AS place FROM movies),
    c AS (SELECT g, row_number() OVER (ORDER BY count(*) DESC, g) AS code FROM v GROUP BY g),
    l AS (SELECT item_id, list(code ORDER BY place) FILTER (code < 6) AS k FROM v JOIN c USING (g) GROUP BY 1),
    z AS (SELECT item_id, list_concat(coalesce(k[greatest(len(k) - 2, 1):], []), [0, 0, 0]) AS k FROM l)
    SELECT item_id, k[1] AS code_1, k[2] AS code_2, k[3] AS code_3 FROM z""",
)
def f07(spark, sf):
    return feat.encode_lists(fx.movies(spark, sf), "item_id", "genres", n=6)


@query(
    "f20_sentence_vectors",
    """WITH t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents),
    r AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS vec_id FROM t WHERE NOT regexp_matches(word, '\\s') GROUP BY word),
    s AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents),
    e AS (SELECT word, unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM r JOIN embeddings USING (vec_id)),
    n AS (SELECT doc_id, word, count(*) AS n FROM s GROUP BY 1, 2),
    m AS (SELECT doc_id, dim, sum(v * n) / sum(n) AS v FROM n JOIN e USING (word) GROUP BY 1, 2)
    SELECT d.doc_id, CAST(d.dim AS INTEGER) AS dim, round(coalesce(v, 0), 6) + 0.0 AS v
    FROM (SELECT doc_id, unnest(range(64)) AS dim FROM documents) d LEFT JOIN m USING (doc_id, dim)""",
)
def f20(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ranked = with_position(word_count(docs, "text").filter(~F.col("word").rlike(r"\s")), [F.desc("n"), F.col("word")], "pos")
    named = ranked.select("word", (F.col("pos") - 1).alias("id")).join(fx.vectors(spark, sf).select("id", "vec"), "id")
    vectors = feat.sentence_vectors(docs, "doc_id", "text", named.select("word", "vec"), 64)
    return vectors.select("doc_id", F.posexplode("vec").alias("dim", "v")).withColumn("v", F.round("v", 6) + 0.0)


@query(
    "f21_dummies",
    """SELECT o_orderkey, (o_orderstatus = 'F')::INT AS "o_orderstatus_F", (o_orderstatus = 'O')::INT AS "o_orderstatus_O" FROM orders""",
)
def f21(spark, sf):
    out = feat.dummies(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"])
    return out.drop("o_orderstatus")
