"""Windows, sorts, top-k, samples, splits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import windows as win
from tabloom.queries import fixtures as fx
from tabloom.queries.aggregates import logs
from tabloom.queries.registry import query, table

BEST_SQL = f"{fx.POSTS_SQL}, best AS (SELECT location, id, max(retweet_count) AS retweet_count FROM posts GROUP BY 1, 2)"


def best(spark, sf):
    return win.best_per_id(fx.posts(spark, sf), "location", "id", "retweet_count")


@query(
    "w01_topn_rank",
    f"""WITH {BEST_SQL} SELECT * FROM (SELECT location, id, retweet_count,
      CAST(rank() OVER (PARTITION BY location ORDER BY retweet_count DESC) AS INTEGER) AS rank FROM best) WHERE rank <= 3""",
)
def w01(spark, sf):
    return win.topn_rank(best(spark, sf), "location", "retweet_count", 3)


@query(
    "w02_topn_rownum",
    f"""WITH {BEST_SQL} SELECT * FROM (SELECT location, id, retweet_count,
      CAST(row_number() OVER (PARTITION BY location ORDER BY retweet_count DESC, id) AS INTEGER) AS rank FROM best) WHERE rank <= 3""",
)
def w02(spark, sf):
    return win.topn_rownum(best(spark, sf), "location", "retweet_count", "id", 3)


@query(
    "w03_topn_list",
    f"""WITH {BEST_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY location ORDER BY retweet_count DESC, id DESC) AS rank FROM best)
    SELECT location, string_agg(id || ':' || retweet_count, ' ' ORDER BY rank) AS top FROM r WHERE rank <= 3 GROUP BY 1""",
)
def w03(spark, sf):
    lists = win.topn_list(best(spark, sf), "location", "retweet_count", "id", 3)
    shown = F.transform("top", lambda p: F.concat_ws(":", p["id"], p["retweet_count"]))
    return lists.select("location", F.array_join(shown, " ").alias("top"))


@query(
    "w04_last_items",
    f"""WITH {fx.RATINGS_SQL} SELECT user_id, item_id, coalesce(lag(item_id, 1) OVER w, 0) AS last_1,
      coalesce(lag(item_id, 2) OVER w, 0) AS last_2, coalesce(lag(item_id, 3) OVER w, 0) AS last_3
    FROM ratings WINDOW w AS (PARTITION BY user_id ORDER BY ts, item_id)""",
)
def w04(spark, sf):
    return win.last_n(fx.ratings(spark, sf), 3).select("user_id", "item_id", "last_1", "last_2", "last_3")


@query(
    "w04_last_items_in_line",
    f"""WITH {fx.RATINGS_SQL} SELECT user_id, item_id, coalesce(lag(item_id, 1) OVER w, 0) AS last_1, coalesce(lag(item_id, 2) OVER w, 0) AS last_2,
      coalesce(lag(p_name, 1) OVER w, '') AS title_1, coalesce(lag(p_name, 2) OVER w, '') AS title_2,
      coalesce(lag(year(ts), 1) OVER w, 0) AS year_1, coalesce(lag(year(ts), 2) OVER w, 0) AS year_2
    FROM ratings JOIN part ON p_partkey = item_id + 1 WINDOW w AS (PARTITION BY user_id ORDER BY ts, item_id)""",
)
def w04_in_line(spark, sf):
    """The last items with their names and the years of their ratings beside them."""
    titles = table(spark, sf, "part").select((F.col("p_partkey") - 1).alias("item_id"), F.col("p_name").alias("title"))
    rated = fx.ratings(spark, sf).join(titles, "item_id").withColumn("year", F.year("ts").cast("long"))
    out = win.last_n(rated, 2, more=["title", "year"]).na.fill("", ["title_1", "title_2"]).na.fill(0, ["year_1", "year_2"])
    return out.select("user_id", "item_id", "last_1", "last_2", "title_1", "title_2", "year_1", "year_2")


@query(
    "w05_days_since_start",
    """SELECT event_id, round((epoch(date_trunc('second', ts)) - (SELECT min(epoch(date_trunc('second', ts))) FROM events)) / 86400) AS ts_day
    FROM events""",
)
def w05(spark, sf):
    return win.days_since_start(table(spark, sf, "events").select("event_id", "ts")).select("event_id", "ts_day")


GENRE_SQL = f"{fx.RATINGS_SQL}, {fx.MOVIES_SQL}, long AS (SELECT user_id, item_id, rating, unnest(string_split(genres, '|')) AS genre FROM ratings JOIN movies USING (item_id))"


def rated_genres(spark, sf):
    movies = fx.movies(spark, sf).select("item_id", F.split("genres", r"\|").alias("genre"))
    return fx.ratings(spark, sf).join(movies, "item_id")


@query(
    "w06_norm_rating",
    f"""WITH {GENRE_SQL}, b AS (SELECT *, min(rating) OVER w AS low, max(rating) OVER w AS high FROM long WINDOW w AS (PARTITION BY user_id, genre))
    SELECT user_id, item_id, round(avg(CASE WHEN high = low THEN 0 ELSE (rating - low) / (high - low) * 5 END), 6) AS norm_rating
    FROM b GROUP BY 1, 2""",
)
def w06(spark, sf):
    return win.norm_rating(rated_genres(spark, sf)).withColumn("norm_rating", F.round("norm_rating", 6))


@query(
    "w07_loved_flag",
    f"""WITH {GENRE_SQL}, m AS (SELECT user_id, avg(rating) OVER (PARTITION BY user_id, genre) AS g FROM long),
    t AS (SELECT user_id, round(avg(g), 9) AS limit_ FROM m GROUP BY 1)
    SELECT user_id, item_id, CAST(rating > limit_ AS INTEGER) AS loved, round(limit_, 6) AS user_threshold FROM ratings JOIN t USING (user_id)""",
)
def w07(spark, sf):
    out = win.loved_flag(rated_genres(spark, sf))
    return out.select("user_id", "item_id", "loved", F.round("user_threshold", 6).alias("user_threshold"))


@query("w08_sort", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def w08(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@query(
    "w09_topk_by_count",
    f"WITH {fx.LOG_SQL} SELECT endpoint, count(*) AS n FROM logs GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 10",
)
def w09(spark, sf):
    return win.topk(logs(spark, sf).groupBy("endpoint").agg(F.count(F.lit(1)).alias("n")), "n", "endpoint", 10)


@query("w10_bottom_k", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 7")
def w10(spark, sf):
    return win.topk(table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "p_partkey", 7, ascending=True)


TOP_ERRORS_SQL = f"""WITH {fx.LOG_SQL} SELECT endpoint, count(*) AS n FROM logs WHERE response_code <> 200
    GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 10"""


@query("w11_top_error_endpoints", TOP_ERRORS_SQL)
def w11(spark, sf):
    return win.top_errors(logs(spark, sf), "endpoint", 10, F.col("response_code") != 200)


@query(
    "w11_top_missing_hosts",
    f"WITH {fx.LOG_SQL} SELECT host, count(*) AS n FROM logs WHERE response_code = 404 GROUP BY 1 ORDER BY n DESC, host LIMIT 25",
)
def w11_hosts(spark, sf):
    return win.top_errors(logs(spark, sf), "host", 25, F.col("response_code") == 404)


@query("w12_sample")
def w12(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    parts = [win.sample(lines, 0.2, False, 3), win.sample(lines, 0.2, True, 3), win.sample_exact(lines, 50, 3)]
    return win.union_all(*[p.withColumn("kind", F.lit(i)) for i, p in enumerate(parts)])


@query(
    "w13_random_split",
    """SELECT o_orderkey, CASE WHEN ('0x' || substr(md5('5|' || o_orderkey), 1, 8))::BIGINT / 4294967296 < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part
    FROM orders""",
)
def w13(spark, sf):
    train, test = win.split(table(spark, sf, "orders").select("o_orderkey"), [0.8, 0.2], ["o_orderkey"], 5)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


HELD_SQL = """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY md5('0|' || user_id || '|' || item_id), item_id) AS rn,
      count(*) OVER (PARTITION BY user_id) AS n FROM ratings"""


@query(
    "w14_split_per_user",
    f"WITH {fx.RATINGS_SQL} SELECT user_id, item_id, rn <= ceil(n * 0.2::DOUBLE) AS for_testing FROM ({HELD_SQL})",
)
def w14(spark, sf):
    return win.split_per_user(fx.ratings(spark, sf)).select("user_id", "item_id", "for_testing")


@query(
    "w15_split_items",
    f"WITH {fx.RATINGS_SQL} SELECT user_id, item_id, rn <= floor(n * 0.75::DOUBLE) AS for_training FROM ({HELD_SQL})",
)
def w15(spark, sf):
    return win.split_items(fx.ratings(spark, sf)).select("user_id", "item_id", "for_training")


@query(
    "w16_kfold",
    "SELECT o_orderkey, CAST(('0x' || substr(md5('1|' || o_orderkey), 1, 8))::BIGINT % 5 AS INTEGER) AS fold FROM orders",
)
def w16(spark, sf):
    return win.kfold(table(spark, sf, "orders").select("o_orderkey"), 5, ["o_orderkey"], 1)


# --- set operations -----------------------------------------------------------------------


@query("u01_union", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT s_name FROM supplier")
def u01(spark, sf):
    named = (("nation", "n_name"), ("region", "r_name"), ("supplier", "s_name"))
    return win.union_all(*[table(spark, sf, t).select(F.col(c).alias("name")) for t, c in named])


@query("u02_vocabulary", f"WITH {fx.POSTS_SQL} SELECT DISTINCT unnest(hashtags) AS item FROM posts")
def u02(spark, sf):
    return win.vocabulary(fx.posts(spark, sf), "hashtags")


@query("u03_intersect", "SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events")
def u03(spark, sf):
    return win.intersect_keys(
        table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "events").select(F.col("user_id").alias("k"))
    )


@query("u04_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT user_id FROM events")
def u04(spark, sf):
    users = table(spark, sf, "events").select(F.col("user_id").alias("k"))
    return win.except_keys(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), users)
