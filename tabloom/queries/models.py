"""Models, model choice, user functions and lifecycle verbs."""

from __future__ import annotations

import operator

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloom.functions import text
from tabloom.operators import features as feat
from tabloom.operators import codes, models, udfs
from tabloom.operators import windows as win
from tabloom.queries import fixtures as fx
from tabloom.plans import written
from tabloom.queries.registry import query, table


def labelled_texts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return docs.join(labels, "doc_id")


def labelled_vectors(spark, sf, target=None):
    """(id, features, label): embeddings, the label turned to one class against the rest."""
    label = F.col("label").cast("double") if target is None else (F.col("label") == target).cast("double")
    return fx.vectors(spark, sf).select("id", array_to_vector("vec").alias("features"), label.alias("label"))


def order_rows(spark, sf):
    """Orders with a late flag, a category or two and numbers."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), "o_orderpriority", F.month("o_orderdate").cast("double").alias("month"),
        F.dayofweek("o_orderdate").cast("double").alias("weekday"), (F.col("o_totalprice") / 1000).alias("price"),
        ((F.col("o_totalprice") > 200000) | (F.col("o_orderstatus") == "P")).cast("double").alias("label"),
    )


def split(df, key="id"):
    return win.split(df, [0.8, 0.2], [key], 3)


@query("m01_text_classifier")
def m01(spark, sf):
    train, test = split(labelled_texts(spark, sf), "doc_id")
    return models.text_classifier(train).transform(test).select("doc_id", "label", "prediction")


@query("m02_tree_classifier")
def m02(spark, sf):
    train, test = split(order_rows(spark, sf))
    model = models.tree_classifier(train, ["o_orderpriority"], ["month", "weekday", "price"])
    return model.transform(test).select("id", "label", "prediction")


@query("m03_logistic_regression")
def m03(spark, sf):
    train, test = split(labelled_vectors(spark, sf, 3))
    out = models.positive_probability(models.logreg(train, reg=0.01).transform(test))
    return out.select("id", "label", "prediction", "score")


@query("m04_weighted_logistic")
def m04(spark, sf):
    train, test = split(labelled_vectors(spark, sf, 3))
    return models.logreg(models.class_weights(train), weight="weight", reg=0.01).transform(test).select("id", "prediction")


def price_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label"))
    return VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(lines)


def coefficients(spark, fits):
    rows = [(name, i, float(v)) for name, m in fits.items() for i, v in enumerate([m.intercept, *m.coefficients])]
    return spark.createDataFrame(rows, "model string, term int, value double")


@query("m05_ridge_and_lasso")
def m05_regularised(spark, sf):
    rows = price_rows(spark, sf)
    return coefficients(spark, {
        "normal": models.linreg(rows, solver="normal"), "ridge": models.linreg(rows, reg=10.0), "lasso": models.linreg(rows, reg=10.0, mix=1.0),
    })


@query("m06_gradient_fit")
def m06(spark, sf):
    return coefficients(spark, {"l-bfgs": models.linreg(price_rows(spark, sf), solver="l-bfgs")})


@query(
    "m07_knn",
    f"""WITH {fx.VECTORS_SQL}, d AS (SELECT a.id, b.label, row_number() OVER (PARTITION BY a.id ORDER BY
      list_distance(a.vec, b.vec), b.id) AS rn FROM vectors a JOIN vectors b ON a.id <> b.id),
    v AS (SELECT id, label, count(*) AS n FROM d WHERE rn <= 5 GROUP BY 1, 2),
    r AS (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS rn FROM v)
    SELECT id, label AS prediction FROM r WHERE rn = 1""",
)
def m07(spark, sf):
    points = fx.vectors(spark, sf)
    return models.knn(points, points, 5, skip_self=True)


@query("m08_random_forest")
def m08(spark, sf):
    train, test = split(labelled_vectors(spark, sf, 3))
    return models.random_forest(train, trees=10).transform(test).select("id", "prediction")


@query("m08_bagging")
def m08_bagging(spark, sf):
    train, test = split(labelled_vectors(spark, sf, 3))
    return models.vote(models.bagging(train, 3), test, "id")


@query("m09_boosted_trees")
def m09(spark, sf):
    train, test = split(order_rows(spark, sf))
    vectors = VectorAssembler(inputCols=["month", "weekday", "price"], outputCol="features")
    return models.gbt(vectors.transform(train), rounds=5).transform(vectors.transform(test)).select("id", "prediction")


@query("m10_linear_svm")
def m10(spark, sf):
    train, test = split(labelled_vectors(spark, sf, 3))
    return models.linear_svm(train, iterations=10).transform(test).select("id", "prediction")


@query("m10_one_vs_rest")
def m10_multi(spark, sf):
    train, test = split(labelled_vectors(spark, sf))
    return models.one_vs_rest(train).transform(test).select("id", "label", "prediction")


CODES = codes.code_matrix(10, 15)
CODES_SQL = "codes(class, col, bit) AS (VALUES " + ", ".join(f"({c}, {j}, {b})" for c, row in enumerate(CODES) for j, b in enumerate(row)) + ")"


@query(
    "m10_output_codes",
    f"""WITH {fx.VECTORS_SQL}, {CODES_SQL},
    e AS (SELECT id, label, ('0x' || substr(md5('3|' || id), 1, 8))::BIGINT / 4294967296 < 0.8::DOUBLE AS train, unnest(range(len(vec))) AS dim, unnest(vec) AS v FROM vectors),
    means AS (SELECT col, bit, dim, avg(v) AS m FROM e JOIN codes ON class = label WHERE train GROUP BY ALL),
    gaps AS (SELECT id, label, col, sum((v - m) * (v - m)) FILTER (bit = 0) AS zero, sum((v - m) * (v - m)) FILTER (bit = 1) AS one
      FROM e JOIN means USING (dim) WHERE NOT train GROUP BY id, label, col),
    far AS (SELECT id, label, class, sum((codes.bit <> (zero > one)::INT)::INT) AS d FROM gaps JOIN codes USING (col) GROUP BY id, label, class),
    bits AS (SELECT id, string_agg((zero > one)::INT, '' ORDER BY col) AS bits FROM gaps GROUP BY id)
    SELECT id, label, bits, arg_min(class, d * 100 + class) AS prediction, min(d)::INTEGER AS wrong_bits FROM far JOIN bits USING (id) GROUP BY id, label, bits""",
)
def m10_codes(spark, sf):
    """Fifteen columns over ten classes, each decided by the nearer of two means."""
    train, test = split(fx.vectors(spark, sf))
    model = codes.fit_centroids(train, codes=CODES)
    out = model.predict(test)
    return out.select(
        "id", "label", F.reverse(F.lpad(F.bin(F.get("bits", F.lit(0))), 15, "0")).alias("bits"), "prediction",
        codes.nearest_distance(F.col("bits"), CODES).alias("wrong_bits"),
    )


@query("m10_output_codes_svm")
def m10_codes_svm(spark, sf):
    train, test = split(labelled_vectors(spark, sf))
    model = codes.fit_columns(written(train, "codes-train"), LinearSVC(maxIter=10, regParam=0.01), columns=15)
    return model.predict(test).select("id", "label", "prediction")


@query("m11_naive_bayes")
def m11(spark, sf):
    docs = labelled_texts(spark, sf).withColumn("words", text.words(F.col("text")))
    counts = feat.hashing_tf(docs, "words", 1 << 10).select("doc_id", "features", "label")
    train, test = split(counts, "doc_id")
    return models.naive_bayes(train).transform(test).select("doc_id", "label", "prediction")


@query("m12_compare_models")
def m12(spark, sf):
    rows = labelled_vectors(spark, sf, 3).cache()
    out = models.compare_models(rows, {"logistic": LogisticRegression(maxIter=5), "tree": DecisionTreeClassifier(maxDepth=3)}, folds=5)
    rows.unpersist()
    return out


@query("m13_grid_search")
def m13(spark, sf):
    rows = labelled_vectors(spark, sf, 3).cache()
    _, scores = models.grid_search(rows, LogisticRegression(maxIter=5), {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.5]}, folds=1, tries=3)
    rows.unpersist()
    return scores


@query("m14_cross_validated_prediction")
def m14(spark, sf):
    return models.cv_predict(labelled_vectors(spark, sf, 3), LogisticRegression(maxIter=5), "id", 5)


@query("m19_learning_curve")
def m19(spark, sf):
    rows = labelled_vectors(spark, sf, 3).cache()
    out = models.learning_curve(rows, LogisticRegression(maxIter=5), [0.3, 1.0], "id")
    rows.unpersist()
    return out


NUMBERS = ["month", "weekday", "price"]


@query("m21_importance")
def m21(spark, sf):
    return models.importance(order_rows(spark, sf), NUMBERS)


@query("m21_recursive_elimination")
def m21_rfe(spark, sf):
    kept = models.rfe(order_rows(spark, sf), NUMBERS, keep=2)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


@query("m22_forward_selection")
def m22(spark, sf):
    return models.forward_select(order_rows(spark, sf), NUMBERS, DecisionTreeClassifier(maxDepth=3), "id", n=3)


@query("m23_incremental_features")
def m23(spark, sf):
    return models.add_features_eval(order_rows(spark, sf), NUMBERS, NaiveBayes(modelType="gaussian"), "id")


@query("m26_partial_dependence")
def m26(spark, sf):
    rows = order_rows(spark, sf)
    model = models.tree_classifier(rows, [], NUMBERS)
    return models.partial_dependence(model, rows, "price", [50.0, 150.0, 250.0, 350.0])


@query(
    "m26_partial_dependence_linear",
    """WITH f AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b, count(*) AS n FROM lineitem)
    SELECT value, round(a + b * value, 3) AS mean_score, n AS rows FROM f, (VALUES (1.0::DOUBLE), (25.0::DOUBLE), (50.0::DOUBLE)) AS t(value)""",
)
def m26_linear(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    vectors = VectorAssembler(inputCols=["l_quantity"], outputCol="features")
    model = PipelineModel([vectors, models.linreg(vectors.transform(lines), solver="normal")])
    out = models.partial_dependence(model, lines, "l_quantity", [1.0, 25.0, 50.0], score="prediction")
    return out.withColumn("mean_score", F.round("mean_score", 3))


# --- user functions and lifecycle -------------------------------------------------------------


@query("d01_untyped_function", "SELECT p_partkey, CAST(p_size * p_size AS VARCHAR) AS square FROM part")
def d01(spark, sf):
    udfs.register(spark, "square_text", lambda x: x * x)
    table(spark, sf, "part").createOrReplaceTempView("part_sizes")
    return spark.sql("SELECT p_partkey, square_text(p_size) AS square FROM part_sizes")


@query("d02_typed_function", "SELECT p_partkey, CAST(p_size * p_size AS BIGINT) AS square FROM part")
def d02(spark, sf):
    udfs.register(spark, "square_number", lambda x: x * x, "long")
    table(spark, sf, "part").createOrReplaceTempView("part_sizes")
    return spark.sql("SELECT p_partkey, square_number(p_size) AS square FROM part_sizes")


@query("d03_column_function", "SELECT p_partkey, CAST(p_size * p_size AS BIGINT) AS square FROM part")
def d03(spark, sf):
    square = udfs.column_udf(lambda x: x * x, "long")
    return table(spark, sf, "part").select("p_partkey", square("p_size").alias("square"))


@query("d04_combine_by_key", "SELECT DISTINCT CAST(day(ts) AS INTEGER) AS day, user_id FROM events")
def d04(spark, sf):
    days = table(spark, sf, "events").select(F.dayofmonth("ts").alias("day"), "user_id")
    return udfs.combine_by_key(days, "day", "user_id")


@query(
    "d04_user_combiners",
    """SELECT l_suppkey AS supplier, count(*) AS n, sum(l_quantity)::BIGINT AS quantity, round(avg(l_quantity), 6) AS mean,
      string_agg(l_quantity::INTEGER, ',' ORDER BY l_quantity) AS list FROM lineitem GROUP BY 1""",
)
def d04_combiners(spark, sf):
    """Sum with count, and the list with repeats, by functions of the user's own."""
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("supplier"), F.col("l_quantity").cast("int").alias("quantity"))
    sums = udfs.aggregate_by_key(
        lines, "supplier", "quantity", lambda v: (v, 1), lambda c, v: (c[0] + v, c[1] + 1), lambda a, b: (a[0] + b[0], a[1] + b[1]),
        "struct<quantity:bigint,n:bigint>", lambda c: {"quantity": c[0], "n": c[1]},
    )
    lists = udfs.aggregate_by_key(lines, "supplier", "quantity", lambda v: [v], lambda c, v: operator.iadd(c, [v]), operator.iadd, "array<int>", sorted)
    sums = sums.select("supplier", "quantity.n", "quantity.quantity", F.round(F.col("quantity.quantity") / F.col("quantity.n"), 6).alias("mean"))
    return sums.join(lists.select("supplier", F.array_join("quantity", ",").alias("list")), "supplier")


@query("l01_cache", "SELECT true AS cached_before, false AS cached_after, count(*) AS n FROM events")
def l01(spark, sf):
    kept = udfs.cache(table(spark, sf, "events"))
    n, before = kept.count(), udfs.cache_state(kept)["cached"]
    after = udfs.cache_state(udfs.release(kept))["cached"]
    return table(spark, sf, "events").agg(
        F.lit(before).alias("cached_before"), F.lit(after).alias("cached_after"), F.least(F.count(F.lit(1)), F.lit(n)).alias("n")
    )


@query("l02_partitions", "SELECT CAST(2 AS BIGINT) AS partitions, count(*) AS n FROM lineitem")
def l02(spark, sf):
    rows = udfs.partitions(udfs.fewer_partitions(table(spark, sf, "lineitem").repartition(8, "l_orderkey"), 2))
    return rows.agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("n"))


@query("l03_plan", "SELECT o_orderkey, true AS pushed FROM orders WHERE o_totalprice > 400000")
def l03(spark, sf):
    df = table(spark, sf, "orders").filter("o_totalprice > 400000").select("o_orderkey")
    return df.withColumn("pushed", F.lit("GreaterThan(o_totalprice" in udfs.plan_text(df)))
