"""Recommenders and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import features as feat
from tabloom.operators import recommend as rec
from tabloom.operators import windows as win
from tabloom.plans import written
from tabloom.queries import fixtures as fx
from tabloom.queries.features import TFIDF_SQL
from tabloom.queries.registry import query, table
from tabloom.queries.windows import HELD_SQL

PART_SQL = f"""{fx.RATINGS_SQL},
  held AS (SELECT user_id, item_id, rn <= ceil(n * 0.2::DOUBLE) AS for_testing FROM ({HELD_SQL})),
  train AS (SELECT r.* FROM ratings r JOIN held USING (user_id, item_id) WHERE NOT for_testing),
  test AS (SELECT r.* FROM ratings r JOIN held USING (user_id, item_id) WHERE for_testing)"""


def parts(spark, sf):
    """(train, test) of the ratings, 20 % of each user's rows held out; written once."""
    flagged = written(win.split_per_user(fx.ratings(spark, sf)), "split")
    return flagged.filter(~F.col("for_testing")), flagged.filter("for_testing")


@query("r01_random")
def r01(spark, sf):
    return rec.recommend_random(fx.ratings(spark, sf), 5, 1)


@query(
    "r02_popular_unseen",
    f"""WITH {PART_SQL}, c AS (SELECT item_id, count(*) AS n FROM train GROUP BY 1),
    u AS (SELECT DISTINCT user_id FROM train),
    x AS (SELECT u.user_id, c.item_id, CAST(row_number() OVER (PARTITION BY u.user_id ORDER BY n DESC, c.item_id) AS INTEGER) AS rank
      FROM u CROSS JOIN c LEFT JOIN train t ON t.user_id = u.user_id AND t.item_id = c.item_id WHERE t.item_id IS NULL)
    SELECT * FROM x WHERE rank <= 5""",
)
def r02(spark, sf):
    return rec.recommend_popular(parts(spark, sf)[0], 5)


@query(
    "r02_popular_all",
    """WITH c AS (SELECT l_partkey AS item_id, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3),
    u AS (SELECT DISTINCT l_suppkey AS user_id FROM lineitem)
    SELECT user_id, item_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item_id) AS INTEGER) AS rank FROM u CROSS JOIN c""",
)
def r02_all(spark, sf):
    sold = table(spark, sf, "lineitem").selectExpr("l_suppkey AS user_id", "l_partkey AS item_id")
    return rec.recommend_popular(sold, 3, remove_seen=False)


@query(
    "r03_top_rated",
    f"""WITH {fx.RATINGS_SQL}, c AS (SELECT item_id, round(avg(rating), 9) AS m FROM ratings GROUP BY 1 HAVING count(*) >= 50),
    u AS (SELECT DISTINCT user_id FROM ratings),
    x AS (SELECT u.user_id, c.item_id, CAST(row_number() OVER (PARTITION BY u.user_id ORDER BY m DESC, c.item_id) AS INTEGER) AS rank
      FROM u CROSS JOIN c LEFT JOIN ratings t ON t.user_id = u.user_id AND t.item_id = c.item_id WHERE t.item_id IS NULL)
    SELECT * FROM x WHERE rank <= 5""",
)
def r03(spark, sf):
    return rec.recommend_top_rated(fx.ratings(spark, sf), 5, 50, remove_seen=True)


ASSOC_SQL = f"""{fx.BASKETS_SQL}, t AS (SELECT count(DISTINCT basket) AS total FROM baskets),
  s AS (SELECT item, count(*) AS n FROM baskets GROUP BY 1),
  p AS (SELECT a.item AS x, b.item AS y, count(*) AS n_xy FROM baskets a JOIN baskets b ON a.basket = b.basket AND a.item <> b.item GROUP BY 1, 2),
  m AS (SELECT x, y, n_xy, n_xy / sx.n AS confidence,
      CASE WHEN sy.n = n_xy THEN 0 ELSE (n_xy / sx.n) / ((sy.n - n_xy) / (total - sx.n)) END AS ratio,
      (n_xy / total) / ((sx.n / total) * (sy.n / total)) AS lift
    FROM p JOIN s sx ON sx.item = x JOIN s sy ON sy.item = y CROSS JOIN t)"""


def best_partners(by):
    return f"""WITH {ASSOC_SQL}, r AS (SELECT x, y, n_xy, round({by}, 6) AS {by},
      CAST(row_number() OVER (PARTITION BY x ORDER BY round({by}, 9) DESC, y) AS INTEGER) AS rank FROM m) SELECT * FROM r WHERE rank <= 5"""


def top_partners(spark, sf, by):
    best = rec.top_associated(rec.associations(fx.basket_items(spark, sf)), by, 5)
    return best.select("x", "y", "n_xy", F.round(by, 6).alias(by), "rank")


@query("r04_assoc_confidence", best_partners("confidence"))
def r04(spark, sf):
    return top_partners(spark, sf, "confidence")


@query("r05_assoc_ratio", best_partners("ratio"))
def r05(spark, sf):
    return top_partners(spark, sf, "ratio")


@query("r06_assoc_lift", best_partners("lift"))
def r06(spark, sf):
    return top_partners(spark, sf, "lift")


@query(
    "r07_item_support",
    f"WITH {fx.BASKETS_SQL} SELECT item, count(*) AS n, round(count(*) / (SELECT count(DISTINCT basket) FROM baskets), 6) AS support FROM baskets GROUP BY 1",
)
def r07(spark, sf):
    return rec.item_support(fx.basket_items(spark, sf)).withColumn("support", F.round("support", 6))


ITEMSETS_SQL = f"""{fx.BASKETS_SQL}, t AS (SELECT count(DISTINCT basket) AS total FROM baskets),
  s1 AS (SELECT item AS a, count(*) AS n FROM baskets GROUP BY 1 HAVING count(*) >= 0.003::DOUBLE * (SELECT total FROM t)),
  s2 AS (SELECT x.item AS a, y.item AS b, count(*) AS n FROM baskets x JOIN baskets y ON x.basket = y.basket AND x.item < y.item
    GROUP BY 1, 2 HAVING count(*) >= 0.003::DOUBLE * (SELECT total FROM t)),
  s3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS n FROM baskets x JOIN baskets y ON x.basket = y.basket AND x.item < y.item
    JOIN baskets z ON z.basket = y.basket AND y.item < z.item GROUP BY 1, 2, 3 HAVING count(*) >= 0.003::DOUBLE * (SELECT total FROM t)),
  s4 AS (SELECT x.item AS a, y.item AS b, z.item AS c, v.item AS d, count(*) AS n FROM baskets x JOIN baskets y ON x.basket = y.basket AND x.item < y.item
    JOIN baskets z ON z.basket = y.basket AND y.item < z.item JOIN baskets v ON v.basket = z.basket AND z.item < v.item
    GROUP BY 1, 2, 3, 4 HAVING count(*) >= 0.003::DOUBLE * (SELECT total FROM t)),
  sets AS (SELECT [a] AS items, n FROM s1 UNION ALL SELECT [a, b], n FROM s2 UNION ALL SELECT [a, b, c], n FROM s3
    UNION ALL SELECT [a, b, c, d], n FROM s4)"""


@query(
    "r08_frequent_itemsets",
    f"WITH {ITEMSETS_SQL} SELECT array_to_string(items, '+') AS items, n, round(n / total, 6) AS support FROM sets, t",
)
def r08(spark, sf):
    sets = rec.frequent_itemsets(fx.basket_items(spark, sf), 0.003)
    return sets.select(F.array_join("items", "+").alias("items"), "n", F.round("support", 6).alias("support"))


def rules_sql(method, threshold):
    return f"""WITH {ITEMSETS_SQL}, e AS (SELECT items, n, unnest(items) AS consequent FROM sets WHERE len(items) > 1),
    r AS (SELECT array_to_string(list_filter(e.items, lambda i: i <> consequent), '+') AS antecedent, consequent,
      e.n / w.n AS confidence, (e.n / w.n) / (one.n / total) AS lift
      FROM e JOIN sets w ON w.items = list_filter(e.items, lambda i: i <> consequent) JOIN sets one ON one.items = [consequent], t)
    SELECT antecedent, consequent, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM r WHERE {method} >= {threshold}::DOUBLE"""


def rules(spark, sf, method, threshold):
    out = rec.assoc_rules(fx.basket_items(spark, sf), 0.003, threshold, method)
    return out.select(
        F.array_join("antecedent", "+").alias("antecedent"), "consequent",
        F.round("confidence", 6).alias("confidence"), F.round("lift", 6).alias("lift"),
    )


@query("r09_rules_by_confidence", rules_sql("confidence", 0.15))
def r09(spark, sf):
    return rules(spark, sf, "confidence", 0.15)


@query("r09_rules_by_lift", rules_sql("lift", 1.05))
def r09_lift(spark, sf):
    return rules(spark, sf, "lift", 1.05)


@query(
    "r10_similar_docs",
    f"""WITH {TFIDF_SQL}, p AS (SELECT a.doc_id AS doc, b.doc_id AS near, sum(a.weight * b.weight) AS sim
      FROM tfidf a JOIN tfidf b ON a.term = b.term AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc ORDER BY round(sim, 9) DESC, near) AS INTEGER) AS rank FROM p)
    SELECT doc, near, round(sim, 6) AS sim, rank FROM r WHERE rank <= 2""",
)
def r10(spark, sf):
    weights = feat.tfidf(table(spark, sf, "documents"), "doc_id", "text")
    return rec.similar_docs(weights, "doc_id", 2).select("doc", "near", F.round("sim", 6).alias("sim"), "rank")


def movie_words(spark, sf):
    words = fx.movies(spark, sf).select("item_id", F.explode(F.split("genres", r"\|")).alias("term"))
    return words.withColumn("weight", F.lit(1.0))


@query(
    "r11_predict_content",
    f"""WITH {PART_SQL}, {fx.MOVIES_SQL}, w AS (SELECT item_id, unnest(string_split(genres, '|')) AS term FROM movies),
    z AS (SELECT item_id, sqrt(count(*)) AS norm FROM w GROUP BY 1),
    s AS (SELECT a.item_id AS i, b.item_id AS j, count(*) / (max(za.norm) * max(zb.norm)) AS sim FROM w a JOIN w b ON a.term = b.term AND a.item_id <> b.item_id
      JOIN z za ON za.item_id = a.item_id JOIN z zb ON zb.item_id = b.item_id GROUP BY 1, 2),
    p AS (SELECT t.user_id, t.item_id, sum(sim * r.rating) / sum(sim) AS score FROM test t JOIN train r ON r.user_id = t.user_id
      JOIN s ON s.i = t.item_id AND s.j = r.item_id GROUP BY 1, 2),
    m AS (SELECT user_id, avg(rating) AS mean FROM train GROUP BY 1)
    SELECT t.user_id, t.item_id, round(coalesce(score, mean), 6) AS score FROM test t LEFT JOIN p USING (user_id, item_id) LEFT JOIN m USING (user_id)""",
)
def r11(spark, sf):
    train, test = parts(spark, sf)
    sims = rec.cosine_sim(movie_words(spark, sf), "item_id", "term", "weight")
    out = rec.predict_content(train, test.select("user_id", "item_id"), sims)
    return out.withColumn("score", F.round("score", 6))


SHARED_SQL = """x AS (SELECT a.user_id AS a, b.user_id AS b, count(*) AS n, sum(a.rating)::DOUBLE AS sa, sum(b.rating)::DOUBLE AS sb,
    sum(a.rating * a.rating)::DOUBLE AS saa, sum(b.rating * b.rating)::DOUBLE AS sbb, sum(a.rating * b.rating)::DOUBLE AS sab
  FROM {0} a JOIN {0} b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY 1, 2)"""


@query(
    "r12_user_sim_euclid",
    f"""WITH {fx.RATINGS_SQL}, {SHARED_SQL.format('ratings')}
    SELECT a, b, round(1 / (1 + sqrt(saa + sbb - 2 * sab)), 6) AS sim FROM x WHERE n >= 14""",
)
def r12(spark, sf):
    return rec.user_sim_euclid(fx.ratings(spark, sf), 14).withColumn("sim", F.round("sim", 6))


@query(
    "r13_user_sim_pearson",
    f"""WITH {fx.RATINGS_SQL}, {SHARED_SQL.format('ratings')}, y AS (SELECT a, b, n * sab - sa * sb AS c, n * saa - sa * sa AS va, n * sbb - sb * sb AS vb FROM x WHERE n >= 14)
    SELECT a, b, round(c / (sqrt(va) * sqrt(vb)), 6) AS sim FROM y WHERE c > 0 AND va > 1e-9 AND vb > 1e-9""",
)
def r13(spark, sf):
    return rec.user_sim_pearson(fx.ratings(spark, sf), 14).withColumn("sim", F.round("sim", 6))


@query(
    "r14_cosine_items",
    f"""WITH {fx.RATINGS_SQL}, z AS (SELECT item_id, sqrt(sum(rating * rating)) AS norm FROM ratings GROUP BY 1),
    p AS (SELECT a.item_id AS a, b.item_id AS b, sum(a.rating * b.rating) AS s FROM ratings a JOIN ratings b
      ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2)
    SELECT a, b, round(s / (za.norm * zb.norm), 6) AS sim FROM p JOIN z za ON za.item_id = a JOIN z zb ON zb.item_id = b""",
)
def r14(spark, sf):
    return rec.cosine_sim(fx.ratings(spark, sf), "item_id", "user_id", "rating").withColumn("sim", F.round("sim", 6))


CF_SQL = f"""{PART_SQL}, {SHARED_SQL.format('train')},
  y AS (SELECT a, b, n * sab - sa * sb AS c, n * saa - sa * sa AS va, n * sbb - sb * sb AS vb FROM x WHERE n >= 6),
  h AS (SELECT a, b, c / (sqrt(va) * sqrt(vb)) AS sim FROM y WHERE c > 0 AND va > 1e-9 AND vb > 1e-9),
  s AS (SELECT a AS u, b AS v, sim FROM h UNION ALL SELECT b, a, sim FROM h),
  im AS (SELECT item_id, avg(rating) AS item_mean FROM train GROUP BY 1),
  um AS (SELECT user_id, avg(rating) AS user_mean FROM train GROUP BY 1)"""


@query(
    "r15_cf_predict",
    f"""WITH {CF_SQL}, p AS (SELECT t.user_id, t.item_id, sum(sim * r.rating) / sum(sim) AS score FROM test t JOIN s ON s.u = t.user_id
      JOIN train r ON r.user_id = s.v AND r.item_id = t.item_id GROUP BY 1, 2)
    SELECT t.user_id, t.item_id, t.rating, round(coalesce(score, item_mean, user_mean), 6) AS score FROM test t
    LEFT JOIN p USING (user_id, item_id) LEFT JOIN im USING (item_id) LEFT JOIN um USING (user_id)""",
)
def r15(spark, sf):
    train, test = parts(spark, sf)
    asked = test.select("user_id", "item_id", "rating")
    return rec.cf_predict(train, asked, 6).withColumn("score", F.round("score", 6))


@query(
    "r16_cf_topn",
    f"""WITH {CF_SQL}, p AS (SELECT s.u AS user_id, r.item_id, sum(sim * r.rating) / sum(sim) AS score FROM s JOIN train r ON r.user_id = s.v GROUP BY 1, 2),
    g AS (SELECT um.user_id, im.item_id, coalesce(score, item_mean) AS score FROM um CROSS JOIN im
      LEFT JOIN p ON p.user_id = um.user_id AND p.item_id = im.item_id LEFT JOIN train t ON t.user_id = um.user_id AND t.item_id = im.item_id
      WHERE t.item_id IS NULL),
    k AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS INTEGER) AS rank FROM g)
    SELECT user_id, item_id, rank, round(score, 6) AS score FROM k WHERE rank <= 5""",
)
def r16(spark, sf):
    train, _ = parts(spark, sf)
    return rec.cf_topn(train, 5, 6).withColumn("score", F.round("score", 6))


@query("r17_svd_recommend")
def r17(spark, sf):
    train, test = parts(spark, sf)
    return rec.svd_recommend(train, test.select("user_id", "item_id", "rating"), 10)


@query(
    "r17_svd_full_rank",
    f"""WITH {PART_SQL}, im AS (SELECT item_id, avg(rating) AS m FROM train GROUP BY 1)
    SELECT user_id, item_id, round(rating, 6)::DOUBLE AS score FROM train
    UNION ALL SELECT user_id, item_id, round(coalesce(m, 3), 6) FROM test LEFT JOIN im USING (item_id)""",
)
def r17_full(spark, sf):
    """With every component kept, rated pairs come back and all others give the item's mean."""
    train, test = parts(spark, sf)
    asked = train.select("user_id", "item_id").unionByName(test.select("user_id", "item_id"))
    out = rec.svd_recommend(train, asked, train.select("item_id").distinct().count())
    return out.withColumn("score", F.round("score", 6))


@query("r18_matrix_factorisation")
def r18(spark, sf):
    train, test = parts(spark, sf)
    return rec.mf_fit(train, rank=5, iterations=5).transform(test).select("user_id", "item_id", "rating", "prediction")


@query(
    "r19_biases",
    f"""WITH {PART_SQL}, mu AS (SELECT avg(rating) AS m FROM train),
    bi AS (SELECT item_id, sum(rating - m) / (count(*) + 5) AS b_i FROM train, mu GROUP BY 1),
    bu AS (SELECT user_id, sum(rating - m - b_i) / (count(*) + 5) AS b_u FROM train JOIN bi USING (item_id), mu GROUP BY 1)
    SELECT t.user_id, t.item_id, round(m + coalesce(b_u, 0) + coalesce(b_i, 0), 6) AS bias
    FROM test t LEFT JOIN bi USING (item_id) LEFT JOIN bu USING (user_id), mu""",
)
def r19(spark, sf):
    train, test = parts(spark, sf)
    return rec.add_bias(test.select("user_id", "item_id"), rec.bias_terms(train)).withColumn("bias", F.round("bias", 6))


@query("r19_bias_factors")
def r19_factors(spark, sf):
    train, test = parts(spark, sf)
    biases, model = rec.mf_bias_fit(train, rank=5, iterations=5)
    return rec.mf_bias_predict(test.select("user_id", "item_id", "rating"), biases, model)


@query("r20_similar_items")
def r20(spark, sf):
    return rec.similar_items(rec.mf_fit(fx.ratings(spark, sf), rank=5, iterations=5), 5)


@query("r21_factorisation_machine")
def r21(spark, sf):
    train, test = parts(spark, sf)
    model = rec.fm_fit(train.withColumn("rating", F.col("rating").cast("double")), ["user_id", "item_id"], iterations=10)
    return model.transform(test).select("user_id", "item_id", "rating", "prediction")


@query(
    "r22_hybrid",
    f"""WITH {CF_SQL}, n AS (SELECT user_id, count(*) AS n FROM train GROUP BY 1),
    f AS (SELECT user_id, n >= (SELECT avg(n) FROM n) AS frequent FROM n),
    c AS (SELECT item_id, count(*) AS pop FROM train GROUP BY 1),
    p AS (SELECT s.u AS user_id, r.item_id, sum(sim * r.rating) / sum(sim) AS score FROM s JOIN train r ON r.user_id = s.v GROUP BY 1, 2),
    g AS (SELECT f.user_id, im.item_id, frequent, pop, coalesce(score, item_mean) AS score FROM f CROSS JOIN im JOIN c ON c.item_id = im.item_id
      LEFT JOIN p ON p.user_id = f.user_id AND p.item_id = im.item_id LEFT JOIN train t ON t.user_id = f.user_id AND t.item_id = im.item_id
      WHERE t.item_id IS NULL),
    k AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN frequent THEN round(score, 9) ELSE pop END DESC, item_id) AS INTEGER) AS rank FROM g)
    SELECT user_id, item_id, rank FROM k WHERE rank <= 5""",
)
def r22(spark, sf):
    train, _ = parts(spark, sf)
    return rec.recommend_hybrid(train, rec.cf_topn(train, 5, 6), 5)


@query(
    "r23_rating_error",
    f"""WITH {PART_SQL}, im AS (SELECT item_id, avg(rating) AS m FROM train GROUP BY 1)
    SELECT round(sqrt(avg(pow(rating - m, 2))), 6) AS rmse, round(avg(abs(rating - m)), 6) AS mae FROM test JOIN im USING (item_id)""",
)
def r23(spark, sf):
    train, test = parts(spark, sf)
    means = train.groupBy("item_id").agg(F.avg("rating").alias("score"))
    out = rec.rating_error(test.join(means, "item_id"))
    return out.select(F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


@query(
    "r24_rank_metrics",
    f"""WITH {PART_SQL}, c AS (SELECT item_id, count(*) AS n FROM train GROUP BY 1), u AS (SELECT DISTINCT user_id FROM train),
    x AS (SELECT u.user_id, c.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY n DESC, c.item_id) AS rank
      FROM u CROSS JOIN c LEFT JOIN train t ON t.user_id = u.user_id AND t.item_id = c.item_id WHERE t.item_id IS NULL),
    rel AS (SELECT user_id, item_id FROM test WHERE rating >= 4), size AS (SELECT user_id, count(*) AS k FROM rel GROUP BY 1),
    h AS (SELECT x.user_id, rank, k, (rel.item_id IS NOT NULL)::INT AS hit FROM x JOIN size USING (user_id)
      LEFT JOIN rel ON rel.user_id = x.user_id AND rel.item_id = x.item_id WHERE rank <= 10),
    g AS (SELECT *, hit * sum(hit) OVER (PARTITION BY user_id ORDER BY rank) / rank AS gain FROM h),
    l AS (SELECT user_id, sum(hit) / count(*) AS p, sum(hit) / max(k) AS r, sum(gain) / least(max(k), count(*)) AS ap FROM g GROUP BY 1),
    m AS (SELECT user_id, coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(ap, 0) AS ap FROM size LEFT JOIN l USING (user_id))
    SELECT round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(ap), 6) AS map, count(*) AS users FROM m""",
)
def r24(spark, sf):
    train, test = parts(spark, sf)
    out = rec.rank_metrics(rec.recommend_popular(train, 10), rec.relevant_fixed(test, 4), 10)
    return out.select("users", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "map")])


@query("r25_relevant_fixed", f"WITH {PART_SQL} SELECT user_id, item_id FROM test WHERE rating >= 4")
def r25(spark, sf):
    return rec.relevant_fixed(parts(spark, sf)[1], 4)


@query(
    "r26_relevant_quantile",
    f"""WITH {PART_SQL}, q AS (SELECT user_id, quantile_cont(rating::DOUBLE, 0.85) AS k FROM test GROUP BY 1)
    SELECT user_id, item_id FROM test JOIN q USING (user_id) WHERE rating >= k""",
)
def r26(spark, sf):
    return rec.relevant_quantile(parts(spark, sf)[1], 0.85)
