"""Invariants of models, features and evaluation."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import aggregates as agg
from tabloom.operators import cluster, linalg, models, rows
from tabloom.operators import evaluate as ev
from tabloom.operators import features as feat
from tabloom.operators import recommend as rec
from tabloom.operators import windows as win
from tabloom.queries import fixtures as fx


def test_auc_matches_evaluator_with_ties(spark):
    rng = np.random.default_rng(0)
    data = [(float(s), int(y)) for s, y in zip(rng.integers(0, 12, 300), rng.integers(0, 2, 300))]
    df = spark.createDataFrame(data, "score double, label int")
    library = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(df)
    assert ev.auc(df).first()["auc"] == pytest.approx(library, abs=1e-9)


def test_roc_and_threshold(spark):
    data = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.1, 1)]
    df = spark.createDataFrame(data, "score double, label int")
    points = {r["score"]: (r["tpr"], r["fpr"]) for r in ev.roc_curve(df).collect()}
    assert points == {0.9: (0, 0), 0.8: (1 / 3, 0), 0.3: (2 / 3, 1 / 2), 0.1: (2 / 3, 1)}
    best = ev.best_threshold(df, 10, 0.3).first()
    values = {s: sum((-10 + 30 * y) for t, y in data if t > s) for s in points}
    top = max(values.values())
    assert best["balance"] == top and best["threshold"] == min(s for s, v in values.items() if v == top)


def test_rank_metrics_by_hand(spark):
    recs = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1), (3, 10, 1)], "user_id long, item_id long, rank int")
    relevant = spark.createDataFrame([(1, 11), (1, 12), (1, 50), (1, 51), (2, 99)], "user_id long, item_id long")
    got = {r["user_id"]: (r["precision"], r["recall"], r["ap"]) for r in rec.user_rank_metrics(recs, relevant, 3).collect()}
    assert got[1] == (pytest.approx(2 / 3), 0.5, pytest.approx((1 / 2 + 2 / 3) / 3))
    assert got[2] == (0, 0, 0) and 3 not in got


def test_pca_identity(spark, small):
    data = fx.vectors(spark, small).select("id", array_to_vector("vec").alias("features"))
    model, projected = linalg.pca(data, "features", 64)
    directions = model.pc.toArray()
    assert np.allclose(directions.T @ directions, np.eye(64), atol=1e-8)
    assert sum(model.explainedVariance.toArray()) == pytest.approx(1)
    p = np.array([r["p"] for r in projected.select(vector_to_array("projection").alias("p")).collect()])
    cov = np.cov(p, rowvar=False)
    assert np.allclose(cov - np.diag(np.diag(cov)), 0, atol=1e-8)


def test_low_rank_matches_numpy(spark, small):
    data = fx.vectors(spark, small).select("id", "vec")
    a = np.array([r["vec"] for r in data.orderBy("id").collect()])
    s = np.linalg.svd(a, compute_uv=False)
    _, stats = linalg.low_rank(data, 6)
    row = stats.first()
    assert row["error"] == pytest.approx(np.sqrt((s[6:] ** 2).sum() / (s**2).sum()), abs=1e-9)
    assert row["ratio"] == pytest.approx(6 * (500 + 65) / (500 * 64))


def test_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    y = 3 + x @ [2.0, -1.0] + rng.normal(size=200) * 0.1
    df = spark.createDataFrame([(float(a), float(b), float(a + b), float(v)) for (a, b), v in zip(x, y)], "a double, b double, c double, y double")
    full = linalg.gram_solve(df, ["a", "b"], "y")
    want = np.linalg.lstsq(np.c_[np.ones(200), x], y, rcond=None)[0]
    assert full == pytest.approx(list(want), abs=1e-8)
    deficient = linalg.gram_solve(df, ["a", "b", "c"], "y")
    design = np.c_[np.ones(200), x, x.sum(axis=1)]
    assert design @ deficient == pytest.approx(design @ np.r_[want, 0], abs=1e-6)


def test_kmeans_assigns_nearest(spark, small):
    assigned, centres, _ = cluster.kmeans(fx.points(spark, small), ["x", "y"], 4, standardise=False)
    again = cluster.nearest_centre(assigned.drop("distance").withColumnRenamed("cluster", "given"), ["x", "y"], centres)
    assert again.filter("given != cluster").isEmpty()
    totals = [r["total"] for r in cluster.elbow(fx.points(spark, small), ["x", "y"], [2, 6]).orderBy("k").collect()]
    assert totals[1] < totals[0]


def test_gmm_likelihood_grows(spark, small):
    weights, _, variances, history = cluster.gmm(fx.points(spark, small), ["x", "y"], [(-0.1, 0), (0.1, 0)], 8)
    assert sum(weights) == pytest.approx(1)
    assert all(v > 0 for d in variances for v in d)
    assert all(b >= a - 1e-9 for a, b in zip(history, history[1:]))


def test_gaussian_score(spark, small):
    out = cluster.gaussian_score(fx.points(spark, small), ["x", "y"]).orderBy("id").collect()
    p = np.array([(r["x"], r["y"]) for r in out])
    gap, cov = p - p.mean(axis=0), np.cov(p, rowvar=False, bias=True)
    want = -0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)
    assert [r["score"] for r in out] == pytest.approx(list(want))
    assert out[0]["density"] == pytest.approx(np.exp(want[0]) / np.sqrt((2 * np.pi) ** 2 * np.linalg.det(cov)))


def test_smote_and_tomek(spark):
    rng = np.random.default_rng(4)
    data = [(i, [float(v) for v in rng.normal(0 if i < 40 else 3, 1, 2)], int(i >= 40)) for i in range(50)]
    points = spark.createDataFrame(data, "id long, vec array<double>, label int")
    made = feat.smote(points, 3)
    counts = {r["label"]: r["count"] for r in made.groupBy("label").count().collect()}
    assert counts == {0: 40, 1: 40}
    old = np.array([v for _, v, y in data if y])
    new = np.array([r["vec"] for r in made.filter("id < 0").collect()])
    assert (new >= old.min(axis=0) - 1e-9).all() and (new <= old.max(axis=0) + 1e-9).all()
    close = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [0.1, 0.0], 1), (3, [9.0, 9.0], 1), (4, [9.2, 9.0], 1)], "id long, vec array<double>, label int")
    assert sorted(r["id"] for r in feat.drop_tomek_links(close).collect()) == [3, 4]


def test_undersample_is_balanced(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in feat.undersample(df, "y", "id").groupBy("y").count().collect()}
    assert counts == {0: 100, 1: 100}


def test_encode_lists_keeps_last_and_pads(spark):
    df = spark.createDataFrame([(1, "A|B|C|D"), (2, "a"), (3, "A|B"), (4, "A|Z")], "id long, g string")
    got = {r["id"]: tuple(r)[1:] for r in feat.encode_lists(df, "id", "g", n=5).collect()}
    # a:4 b:2 c:1 d:1 z:1 -> codes 1..5, and code 5 (z) is dropped
    assert got == {1: (2, 3, 4), 2: (1, 0, 0), 3: (1, 2, 0), 4: (1, 0, 0)}


def test_fill_and_scale(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (99.0,), (None,)], "x double")
    assert sorted(r["x"] for r in feat.fill_mean(df, ["x"], missing=99.0).collect()) == [1.0, 2.0, 2.0, 3.0]
    flat = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r["x"] for r in feat.apply_scaling(flat, feat.fit_standard(flat, ["x"])).collect()] == [0.0, 0.0]


def test_noise_columns(spark):
    out = feat.add_noise(spark.range(500), 4, 7)
    row = out.agg(F.min("random_1"), F.max("random_1"), F.min("random_3"), F.min("random_4")).first()
    assert -1 <= row[0] < row[1] <= 1 and row[2] > 0 and row[3] >= 0


def test_splits_are_whole_and_repeatable(spark):
    df = spark.range(5000)
    train, test = win.split(df, [0.8, 0.2], ["id"], 1)
    assert train.count() + test.count() == 5000 and train.join(test, "id").isEmpty()
    assert 0.75 < train.count() / 5000 < 0.85
    folds = win.kfold(df, 5, ["id"]).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3, 4] and min(r["count"] for r in folds) > 850
    assert win.sample_exact(df, 17).count() == 17
    assert 800 < win.sample(df, 0.2).count() < 1200


def test_cv_predict_covers_every_row(spark, small):
    from pyspark.ml.classification import LogisticRegression

    data = fx.vectors(spark, small).select("id", array_to_vector("vec").alias("features"), (F.col("label") == 3).cast("double").alias("label"))
    out = models.cv_predict(data, LogisticRegression(maxIter=3), "id", 3)
    assert out.count() == 500 and out.select("id").distinct().count() == 500


def test_weights_and_votes(spark):
    df = spark.createDataFrame([(0.0,)] * 9 + [(1.0,)], "label double")
    got = {(r["label"], r["weight"]) for r in models.class_weights(df).collect()}
    assert got == {(0.0, 10 / 18), (1.0, 5.0)}


def test_knn_tie_goes_to_smaller_label(spark):
    train = spark.createDataFrame([(1, [0.0], 7), (2, [1.0], 4)], "id long, vec array<double>, label int")
    test = spark.createDataFrame([(9, [0.4])], "id long, vec array<double>")
    assert models.knn(train, test, 2).first()["prediction"] == 4
    assert models.knn(train, test, 1).first()["prediction"] == 7


def test_partial_dependence_keeps_all_rows(spark):
    df = spark.range(200).select("id", (F.col("id") % 20).cast("double").alias("a"), F.rand(1).alias("b"))
    df = df.withColumn("label", (F.col("a") > 9).cast("double"))
    model = models.tree_classifier(df, [], ["a", "b"])
    out = {r["value"]: (r["mean_score"], r["rows"]) for r in models.partial_dependence(model, df, "a", [0.0, 19.0]).collect()}
    assert out[0.0] == (0.0, 200) and out[19.0] == (1.0, 200)


def test_importance_and_elimination(spark):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("good"), F.rand(3).alias("bad"))
    df = df.withColumn("label", (F.col("good") > 9).cast("double"))
    found = {r["feature"]: r for r in models.importance(df, ["good", "bad"]).collect()}
    assert found["good"]["above_noise"] and found["good"]["importance"] > 0.8
    assert models.rfe(df, ["bad", "good"], keep=1) == ["good"]


def test_svd_and_factor_models(spark):
    rng = np.random.default_rng(8)
    u, v = rng.normal(size=(30, 2)), rng.normal(size=(12, 2))
    full = [(i, j, float(3 + u[i] @ v[j])) for i in range(30) for j in range(12)]
    train = spark.createDataFrame(full, "user_id long, item_id long, rating double")
    asked = spark.createDataFrame([*full, (0, 999, 0.0)], "user_id long, item_id long, rating double")
    out = rec.svd_recommend(train, asked, 3)
    assert out.filter("item_id = 999").first()["score"] == 3.0
    known = out.filter("item_id < 999")
    assert rec.rating_error(known).first()["rmse"] < 1e-6  # rank 2 after centring, so rank 3 is exact
    biases, model = rec.mf_bias_fit(train, rank=2, reg=0.01, iterations=10)
    assert rec.rating_error(rec.mf_bias_predict(train, biases, model)).first()["rmse"] < 0.3


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 127, 40000, 1.5, "a"), (2, 0, 1, 2.5, "b")], "a long, b long, c long, d double, s string")
    assert dict(rows.narrow_types(df).dtypes) == {"a": "tinyint", "b": "smallint", "c": "int", "d": "float", "s": "string"}


def test_correlations_agree(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    columns = ["l_quantity", "l_discount"]
    a = {(r["a"], r["b"]): r["corr"] for r in agg.corr_matrix(lines, columns).collect()}
    b = {(r["a"], r["b"]): r["corr"] for r in agg.corr_pairs(lines, columns).collect()}
    assert a == pytest.approx(b)


def test_spearman_matches_library(spark, small):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    columns = ["l_quantity", "l_discount", "l_extendedprice"]
    got = {(r["a"], r["b"]): r["corr"] for r in agg.corr_matrix(lines, columns, "spearman").collect()}
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(lines)
    want = Correlation.corr(vectors, "v", "spearman").first()[0].toArray()
    assert got == pytest.approx({(a, b): want[i][j] for i, a in enumerate(columns) for j, b in enumerate(columns)}, abs=1e-9)


def test_model_auc_uses_the_probability(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("a"), (F.col("id") > 60).cast("double").alias("label"))
    vectors = feat.assemble(df, ["a"])
    assert models.model_auc(models.logreg(vectors, reg=0.1).transform(vectors)).first()["auc"] == pytest.approx(1.0)


def test_co_ratings(spark):
    from tabloom.operators import joins

    ratings = spark.createDataFrame([(1, 7, 5), (1, 8, 3), (2, 8, 4), (2, 9, 1)], "user_id long, item_id long, rating int")
    assert [tuple(r) for r in joins.co_ratings(ratings, 1, 2).collect()] == [(8, 3, 4)]
    assert [tuple(r) for r in joins.co_rating_counts(ratings).collect()] == [(1, 2, 1)]
