"""Aggregates."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.functions import clf
from tabloom.operators import aggregates as agg
from tabloom.plans import spread
from tabloom.queries import fixtures as fx
from tabloom.queries.registry import query, table


def logs(spark, sf):
    return clf.parse_clf(fx.log_lines(spark, sf)).filter("parsed")


@query(
    "a01_count",
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM orders",
)
def a01(spark, sf):
    orders = table(spark, sf, "orders")
    total = orders.agg(F.lit("all").alias("o_orderstatus"), F.count(F.lit(1)).alias("n"))
    return agg.count_by(orders, "o_orderstatus").unionByName(total)


@query(
    "a02_max_by_group",
    "SELECT p_brand, max(p_size) AS max_p_size, max(p_retailprice) AS max_p_retailprice FROM part GROUP BY 1",
)
def a02(spark, sf):
    return agg.max_by(table(spark, sf, "part").select("p_brand", "p_size", "p_retailprice"), "p_brand")


@query(
    "a03_size_stats",
    f"""WITH {fx.LOG_SQL} SELECT round(avg(content_size), 6) AS avg_size, CAST(floor(avg(content_size)) AS BIGINT) AS avg_size_int,
      min(content_size) AS min_size, max(content_size) AS max_size FROM logs""",
)
def a03(spark, sf):
    return agg.size_stats(logs(spark, sf), "content_size").withColumn("avg_size", F.round("avg_size", 6))


@query("a04_status_counts", f"WITH {fx.LOG_SQL} SELECT response_code, count(*) AS n FROM logs GROUP BY 1")
def a04(spark, sf):
    return agg.count_by(logs(spark, sf), "response_code")


@query("a05_hosts_over", f"WITH {fx.LOG_SQL} SELECT host, count(*) AS n FROM logs GROUP BY 1 HAVING count(*) > 10")
def a05(spark, sf):
    return agg.having_count(logs(spark, sf), "host", 10)


@query(
    "a06_distinct_counts",
    f"WITH {fx.LOG_SQL} SELECT count(DISTINCT host) AS host, count(DISTINCT endpoint) AS endpoint FROM logs",
)
def a06(spark, sf):
    return agg.distinct_count(logs(spark, sf), "host", "endpoint")


@query(
    "a07_daily_hosts",
    f"WITH {fx.LOG_SQL} SELECT CAST(day(date_time) AS INTEGER) AS day, count(DISTINCT host) AS hosts FROM logs GROUP BY 1 ORDER BY 1",
)
def a07(spark, sf):
    return agg.daily_hosts(logs(spark, sf)).orderBy("day")


@query(
    "a08_avg_daily_requests",
    f"""WITH {fx.LOG_SQL} SELECT CAST(day(date_time) AS INTEGER) AS day, round(count(*) / count(DISTINCT host), 6) AS average,
      count(*) // count(DISTINCT host) AS average_int FROM logs GROUP BY 1""",
)
def a08(spark, sf):
    return agg.avg_daily_requests(logs(spark, sf)).withColumn("average", F.round("average", 6))


@query("a09_distinct_values", f"WITH {fx.LOG_SQL} SELECT DISTINCT endpoint FROM logs WHERE response_code = 404 ORDER BY 1 LIMIT 40")
def a09(spark, sf):
    return logs(spark, sf).filter("response_code = 404").select("endpoint").distinct().orderBy("endpoint").limit(40)


@query(
    "a10_errors_by_time",
    f"""WITH {fx.LOG_SQL}, bad AS (SELECT * FROM logs WHERE response_code = 404)
    SELECT 'day' AS part, CAST(day(date_time) AS INTEGER) AS at, count(*) AS n FROM bad GROUP BY 2
    UNION ALL SELECT 'hour', CAST(hour(date_time) AS INTEGER), count(*) FROM bad GROUP BY 2""",
)
def a10(spark, sf):
    bad = logs(spark, sf).filter("response_code = 404")
    days = agg.count_by_part(bad, F.dayofmonth("date_time"), "at").withColumn("part", F.lit("day"))
    hours = agg.count_by_part(bad, F.hour("date_time"), "at").withColumn("part", F.lit("hour"))
    return days.unionByName(hours)


@query("a11_tag_counts", f"WITH {fx.POSTS_SQL} SELECT tag, count(*) AS n FROM (SELECT unnest(hashtags) AS tag FROM posts) GROUP BY 1")
def a11(spark, sf):
    return agg.tag_counts(fx.posts(spark, sf), "hashtags")


@query(
    "a12_count_where_max",
    f"""WITH {fx.POSTS_SQL} SELECT count(*) AS n FROM (SELECT id, max(retweet_count) AS m FROM posts GROUP BY id) WHERE m > 100""",
)
def a12(spark, sf):
    return agg.count_where_max(fx.posts(spark, sf), "id", "retweet_count", 100)


@query("a13_unique_per_group", f"WITH {fx.POSTS_SQL} SELECT location, count(DISTINCT id) AS n FROM posts GROUP BY 1")
def a13(spark, sf):
    return agg.unique_per_group(fx.posts(spark, sf), "location", "id")


@query(
    "a14_word_count",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1",
)
def a14(spark, sf):
    return agg.word_count(spread(table(spark, sf, "documents").select("text")), "text")


@query(
    "a15_top_word_mass",
    """WITH c AS (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS total FROM (SELECT n FROM c ORDER BY n DESC, word LIMIT 5)""",
)
def a15(spark, sf):
    return agg.top_mass(agg.word_count(spread(table(spark, sf, "documents").select("text")), "text"), "word", 5)


@query(
    "a16_fold",
    "SELECT CAST(sum(p_size) AS BIGINT) AS total, max(p_size) AS largest, min(p_size) AS smallest FROM part",
)
def a16(spark, sf):
    return agg.fold(table(spark, sf, "part"), "p_size")


@query(
    "a17_values_per_key",
    """SELECT p_brand, p_size, n, total FROM (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2)
    JOIN (SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS total FROM part GROUP BY 1) USING (p_brand)""",
)
def a17(spark, sf):
    return agg.group_values(table(spark, sf, "part"), "p_brand", "p_size")


@query("a18_count_by_value", "SELECT p_size, count(*) AS n FROM part GROUP BY 1")
def a18(spark, sf):
    return agg.count_by(table(spark, sf, "part"), "p_size")


@query("a19_value_counts", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY n, 1")
def a19(spark, sf):
    return agg.count_by(table(spark, sf, "customer"), "c_mktsegment").orderBy("n", "c_mktsegment")


@query(
    "a20_crosstab",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
      count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""",
)
def a20(spark, sf):
    return agg.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(
    "a21_rates",
    f"""WITH {fx.SCORED_SQL}, r AS (SELECT grp, count(*) FILTER (label = 0) AS no, count(*) FILTER (label = 1) AS yes,
      round(avg(label), 6) AS rate FROM scored GROUP BY 1)
    SELECT r.grp, r.no, r.yes, r.rate, round(r.yes / sum(r.yes) OVER (), 6) AS share FROM r""",
)
def a21(spark, sf):
    data = fx.scored(spark, sf)
    shares = agg.crosstab_norm(data, "grp", "label").filter("label = 1").select("grp", F.round("share", 6).alias("share"))
    return agg.rate_by(data, "grp", "label").withColumn("rate", F.round("rate", 6)).join(shares, "grp")


@query(
    "a22_pivot_mean",
    "SELECT o_orderpriority, "
    + ", ".join(f'round(avg(o_totalprice) FILTER (year(o_orderdate) = {y}), 4) AS "{y}"' for y in fx.ORDER_YEARS)
    + " FROM orders GROUP BY 1",
)
def a22(spark, sf):
    orders = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    wide = agg.pivot_mean(orders, "o_orderpriority", "y", "o_totalprice", fx.ORDER_YEARS)
    return wide.select("o_orderpriority", *[F.round(f"{y}", 4).alias(f"{y}") for y in fx.ORDER_YEARS])


@query(
    "a23_item_stats",
    f"WITH {fx.RATINGS_SQL} SELECT item_id, round(avg(rating), 6) AS mean_rating, count(*) AS n FROM ratings GROUP BY 1",
)
def a23(spark, sf):
    return agg.item_stats(fx.ratings(spark, sf)).withColumn("mean_rating", F.round("mean_rating", 6))


@query(
    "a24_density",
    f"""WITH {fx.RATINGS_SQL} SELECT count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
      round(count(*) / count(DISTINCT user_id), 6) AS per_user, round(count(*) / count(DISTINCT item_id), 6) AS per_item,
      round((1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id))) * 100, 6) AS sparsity FROM ratings""",
)
def a24(spark, sf):
    d = agg.density(fx.ratings(spark, sf))
    return d.select("n", "users", "items", *[F.round(c, 6).alias(c) for c in ("per_user", "per_item", "sparsity")])


@query(
    "a25_longtail",
    """WITH c AS (SELECT l_partkey AS item_id, count(*) AS n FROM lineitem GROUP BY 1),
    p AS (SELECT n, row_number() OVER (ORDER BY n DESC, item_id) AS place, count(*) OVER () AS total FROM c),
    q AS (SELECT n, CASE WHEN place <= floor(total / 10) THEN 'top' WHEN place > total - floor(total / 10) THEN 'bottom'
      WHEN place > floor(total * 0.45) AND place <= floor(total * 0.55) THEN 'middle' END AS part FROM p)
    SELECT part, round(avg(n), 6) AS mean_n FROM q WHERE part IS NOT NULL GROUP BY 1""",
)
def a25(spark, sf):
    ratings = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item_id"))
    return agg.longtail(ratings).withColumn("mean_n", F.round("mean_n", 6))


@query(
    "a26_segment_users",
    f"""WITH {fx.RATINGS_SQL}, c AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY 1)
    SELECT user_id, n, CASE WHEN n >= (SELECT avg(n) FROM c) THEN 'frequent' ELSE 'new' END AS segment FROM c""",
)
def a26(spark, sf):
    return agg.segment_users(fx.ratings(spark, sf))


@query(
    "a27_freq_encode",
    "SELECT c_mktsegment, round(count(*) / (SELECT count(*) FROM customer), 6) AS freq FROM customer GROUP BY 1",
)
def a27(spark, sf):
    return agg.freq_encode(table(spark, sf, "customer"), "c_mktsegment").withColumn("freq", F.round("freq", 6))


def _null_profile_sql() -> str:
    parts = [
        f"SELECT fraudulent, '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, "
        f"round(count(*) FILTER ({c} IS NULL) * 100 / count(*), 6) AS percent FROM jobs GROUP BY 1"
        for c in ("id", "location", "department", "salary", "title")
    ]
    return f"WITH {fx.JOBS_SQL} " + " UNION ALL ".join(parts)


@query("a28_null_profile", _null_profile_sql())
def a28(spark, sf):
    return agg.null_profile(fx.job_ads(spark, sf), "fraudulent").withColumn("percent", F.round("percent", 6))


ROW_NULLS = "(location IS NULL)::INT + (department IS NULL)::INT + (salary IS NULL)::INT + (title IS NULL)::INT"


@query(
    "a29_nulls_per_row",
    f"WITH {fx.JOBS_SQL} SELECT fraudulent, round(avg({ROW_NULLS}), 6) AS mean_nulls, max({ROW_NULLS}) AS max_nulls FROM jobs GROUP BY 1",
)
def a29(spark, sf):
    out = agg.nulls_per_row(fx.job_ads(spark, sf), ["location", "department", "salary", "title"], "fraudulent")
    return out.withColumn("mean_nulls", F.round("mean_nulls", 6))


def _cooccurrence_sql() -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", {n} AS n, round(avg(({c} IS NULL AND {ROW_NULLS} >= {n})::INT) * 100, 6) AS percent FROM jobs"
        for c in ("location", "department", "salary", "title")
        for n in (1, 2, 3, 4)
    ]
    return f"WITH {fx.JOBS_SQL} " + " UNION ALL ".join(parts)


@query("a30_null_cooccurrence", _cooccurrence_sql())
def a30(spark, sf):
    out = agg.null_cooccurrence(fx.job_ads(spark, sf), ["location", "department", "salary", "title"])
    return out.withColumn("percent", F.round("percent", 6))


@query(
    "a31_histogram",
    """SELECT c_mktsegment, CAST(least(floor((c_acctbal + 1000) / 550), 19) AS INTEGER) AS bin, count(*) AS n
    FROM customer WHERE c_acctbal BETWEEN -1000 AND 10000 GROUP BY 1, 2""",
)
def a31(spark, sf):
    return agg.histogram(table(spark, sf, "customer"), "c_acctbal", 20, -1000, 10000, "c_mktsegment")


@query("a32_mean_median", "SELECT round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 6) AS median FROM orders")
def a32(spark, sf):
    out = agg.mean_median(table(spark, sf, "orders"), "o_totalprice")
    return out.select(F.round("mean", 4).alias("mean"), F.round("median", 6).alias("median"))


LINE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "a33_pearson_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS corr FROM lineitem" for a in LINE_COLS for b in LINE_COLS
    ),
)
def a33(spark, sf):
    out = agg.corr_matrix(table(spark, sf, "lineitem"), LINE_COLS)
    return out.withColumn("corr", F.round("corr", 6) + 0.0)


@query(
    "a34_spearman_matrix",
    "WITH r AS (SELECT "
    + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in LINE_COLS)
    + " FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS corr FROM r" for a in LINE_COLS for b in LINE_COLS),
)
def a34(spark, sf):
    out = agg.corr_matrix(table(spark, sf, "lineitem"), LINE_COLS, "spearman")
    return out.withColumn("corr", F.round("corr", 6) + 0.0)


@query(
    "a35_vector_summary",
    """SELECT round(avg(l_discount), 9) AS m0, round(avg(l_tax), 9) AS m1, count(*) AS n,
      round(sum(l_discount * l_quantity) / sum(l_quantity), 9) AS w0, round(sum(l_tax * l_quantity) / sum(l_quantity), 9) AS w1 FROM lineitem""",
)
def a35(spark, sf):
    vec = VectorAssembler(inputCols=["l_discount", "l_tax"], outputCol="v").transform(table(spark, sf, "lineitem"))
    plain = agg.summarize(vec, "v").select(vector_to_array("mean").alias("m"), F.col("count").alias("n"))
    heavy = agg.summarize(vec, "v", "l_quantity").select(vector_to_array("mean").alias("w"))
    both = plain.withColumn("w", heavy.scalar())
    return both.select(
        "n", *[F.round(F.col(c)[i], 9).alias(f"{c}{i}") for c in ("m", "w") for i in (0, 1)]
    )


@query(
    "a36_autocorrelation",
    f"""WITH {fx.SERIES_SQL}, c AS (SELECT series, t, value - avg(value) OVER (PARTITION BY series) AS x FROM series),
    v AS (SELECT series, sum(x * x) AS s0 FROM c GROUP BY 1),
    p AS (SELECT a.series, b.t - a.t AS lag, sum(a.x * b.x) AS s FROM c a JOIN c b ON a.series = b.series AND b.t - a.t BETWEEN 0 AND 10
      AND b.t IN (a.t, a.t + 1, a.t + 2, a.t + 3, a.t + 4, a.t + 5, a.t + 6, a.t + 7, a.t + 8, a.t + 9, a.t + 10) GROUP BY 1, 2)
    SELECT p.series, CAST(lag AS INTEGER) AS lag, round(s / s0, 6) AS acf FROM p JOIN v USING (series)""",
)
def a36(spark, sf):
    return agg.acf(fx.series(spark, sf), 10).withColumn("acf", F.round("acf", 6))


@query(
    "a37_series_error",
    f"""WITH {fx.SERIES_SQL} SELECT series, round(avg(pow(value - id % 50, 2)), 4) AS mse, round(stddev_samp(value), 6) AS sd
    FROM series GROUP BY 1""",
)
def a37(spark, sf):
    data = fx.series(spark, sf).withColumn("guess", F.col("id") % 50)
    out = agg.series_error(data, "value", "guess", "series")
    return out.select("series", F.round("mse", 4).alias("mse"), F.round("sd", 6).alias("sd"))
