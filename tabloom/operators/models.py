"""Classifiers, regressions, model choice and feature choice on Spark ML.

Fits run on the executors; loops here only go over folds, sizes or feature lists, never over
rows.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, StandardScaler, StringIndexer, Tokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.aggregates import count_by
from tabloom.operators.evaluate import auc, binary_metrics
from tabloom.operators.features import add_noise
from tabloom.operators.joins import with_grid
from tabloom.operators.windows import hash_unit, kfold
from tabloom.plans import nearest_neighbours, written

# --- fits -----------------------------------------------------------------------------------


def text_classifier(train: DataFrame, text: str = "text", label: str = "label", size: int = 1 << 12, iterations: int = 10) -> Model:
    """Blank-split words, hashed counts, logistic regression."""
    return Pipeline(stages=[
        Tokenizer(inputCol=text, outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="features", numFeatures=size),
        LogisticRegression(maxIter=iterations, regParam=0.001, labelCol=label),
    ]).fit(train)


def tree_classifier(train: DataFrame, categories: Sequence[str], numbers: Sequence[str], label: str = "label", depth: int = 5) -> Model:
    """Indexed categories and numbers into one decision tree."""
    codes = [f"_{c}" for c in categories]
    # A split needs a bin for each category, one of them for values the training rows lack.
    sizes = train.agg(F.lit(0).alias("_"), *[F.count_distinct(c).alias(n) for c, n in zip(categories, codes, strict=True)]).first()
    bins = max(64, *(size + 1 for size in sizes)) if categories else 64
    stages = [StringIndexer(inputCols=list(categories), outputCols=codes, handleInvalid="keep")] if categories else []
    stages += [
        VectorAssembler(inputCols=[*codes, *numbers], outputCol="features"),
        DecisionTreeClassifier(labelCol=label, maxDepth=depth, maxBins=bins),
    ]
    return Pipeline(stages=stages).fit(train)


def accuracy(predicted: DataFrame, label: str = "label") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(predicted)


def class_weights(train: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Add ``rows / (classes * rows of the class)``, so that classes weigh the same."""
    counts = count_by(train, label, name="_n")
    sizes = counts.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    balanced = counts.select(label, (F.lit(sizes["rows"]) / (sizes["classes"] * F.col("_n"))).alias(name))
    return train.join(balanced, label)


def logreg(train: DataFrame, label: str = "label", weight: str | None = None, reg: float = 0.0, iterations: int = 50) -> Model:
    """Logistic regression with probabilities, also weighted by class."""
    fit = LogisticRegression(labelCol=label, regParam=reg, maxIter=iterations)
    return (fit.setWeightCol(weight) if weight else fit).fit(train)


def linreg(train: DataFrame, label: str = "label", reg: float = 0.0, mix: float = 0.0, solver: str = "auto") -> Model:
    """Linear regression: normal equations, ridge (``mix=0``), lasso (``mix=1``) or l-bfgs."""
    return LinearRegression(labelCol=label, regParam=reg, elasticNetParam=mix, solver=solver).fit(train)


def knn(train: DataFrame, test: DataFrame, k: int, skip_self: bool = False) -> DataFrame:
    """(id, prediction): the most common label among the k nearest of ``(id, vec, label)``.

    Equal votes go to the smaller label.
    """
    near = nearest_neighbours(test.select("id", "vec"), train.select("id", "vec"), k, skip_self=skip_self)
    votes = near.join(train.select(F.col("id").alias("ref"), "label"), "ref")
    counts = votes.groupBy(F.col("query").alias("id"), "label").agg(F.count(F.lit(1)).alias("_n"))
    best = F.max(F.struct("_n", (-F.col("label")).alias("_l")))
    return counts.groupBy("id").agg((-best["_l"]).alias("prediction"))


def random_forest(train: DataFrame, label: str = "label", trees: int = 20, depth: int = 5, seed: int = 0) -> Model:
    return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(train)


def bagging(train: DataFrame, n: int = 5, label: str = "label", depth: int = 5, seed: int = 0) -> list[Model]:
    """One tree per bootstrap sample."""
    tree = DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=seed)
    return [tree.fit(train.sample(True, 1.0, seed + i)) for i in range(n)]


def vote(models: Sequence[Model], df: DataFrame, key: str) -> DataFrame:
    """(key, prediction): majority of the models; equal votes go to the smaller label."""
    parts = [m.transform(df).select(key, "prediction") for m in models]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    counts = every.groupBy(key, "prediction").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg((-F.max(F.struct("_n", (-F.col("prediction")).alias("_l")))["_l"]).alias("prediction"))


def gbt(train: DataFrame, label: str = "label", rounds: int = 20, depth: int = 4, seed: int = 0) -> Model:
    return GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed).fit(train)


def linear_svm(train: DataFrame, label: str = "label", reg: float = 0.01, iterations: int = 30) -> Model:
    return LinearSVC(labelCol=label, regParam=reg, maxIter=iterations).fit(train)


def one_vs_rest(train: DataFrame, classifier: Estimator | None = None, label: str = "label", parallelism: int = 4) -> Model:
    base = classifier or LinearSVC(maxIter=10, regParam=0.01)
    return OneVsRest(classifier=base, labelCol=label, parallelism=parallelism).fit(train)


def naive_bayes(train: DataFrame, kind: str = "multinomial", label: str = "label") -> Model:
    return NaiveBayes(modelType=kind, labelCol=label).fit(train)


# --- choice of models -----------------------------------------------------------------------


def compare_models(train: DataFrame, models: Mapping[str, Estimator], folds: int = 5, label: str = "label", seed: int = 0, parallelism: int = 4) -> DataFrame:
    """(model, mean_auc, sd_auc): k-fold area under the curve per estimator."""
    metric = BinaryClassificationEvaluator(labelCol=label)
    rows = []
    for name, estimator in models.items():
        fitted = CrossValidator(
            estimator=estimator, estimatorParamMaps=[{}], evaluator=metric, numFolds=folds, seed=seed, parallelism=parallelism
        ).fit(train)
        rows.append((name, float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0])))
    return train.sparkSession.createDataFrame(rows, "model string, mean_auc double, sd_auc double")


def param_grid(estimator: Estimator, values: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of the given parameter values."""
    grid = ParamGridBuilder()
    for name, options in values.items():
        grid = grid.addGrid(estimator.getParam(name), list(options))
    return grid.build()


def grid_search(train: DataFrame, estimator: Estimator, values: Mapping[str, Sequence], folds: int = 3, tries: int | None = None, label: str = "label", seed: int = 0, parallelism: int = 4):
    """(best model, table of parameter sets and mean AUC). ``tries`` draws that many sets at random;
    one fold means a single train/validation split."""
    grid = param_grid(estimator, values)
    if tries is not None and tries < len(grid):
        grid = random.Random(seed).sample(grid, tries)
    common = dict(
        estimator=estimator, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol=label),
        seed=seed, parallelism=parallelism,
    )
    if folds > 1:
        fitted = CrossValidator(numFolds=folds, **common).fit(train)
        scores = fitted.avgMetrics
    else:
        fitted = TrainValidationSplit(trainRatio=0.75, **common).fit(train)
        scores = fitted.validationMetrics
    shown = [", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda x: x[0].name)) for g in grid]
    table = train.sparkSession.createDataFrame(
        [(s, float(a)) for s, a in zip(shown, scores)], "parameters string, mean_auc double"
    )
    return fitted.bestModel, table


def cv_predict(df: DataFrame, estimator: Estimator, key: str, folds: int = 5, vector: str = "features", seed: int = 0) -> DataFrame:
    """(key, fold, prediction): every row predicted by a model that never saw it; the scaler is
    fitted anew on each fold's training rows."""
    parted = written(kfold(df, folds, [key], seed), "folds")
    out = None
    for f in range(folds):
        scaler = StandardScaler(withMean=True, withStd=True, inputCol=vector, outputCol="_scaled")
        fitted = Pipeline(stages=[scaler, estimator.copy({estimator.getParam("featuresCol"): "_scaled"})]).fit(
            parted.filter(F.col("fold") != f)
        )
        part = fitted.transform(parted.filter(F.col("fold") == f)).select(key, "fold", "prediction")
        out = part if out is None else out.unionByName(part)
    return out


def learning_curve(df: DataFrame, estimator: Estimator, fractions: Sequence[float], key: str, label: str = "label", seed: int = 0) -> DataFrame:
    """(fraction, rows, train_error, test_error) for growing shares of the training rows.

    A share keeps the rows whose hash is low, so a larger share contains the smaller ones.
    """
    at = hash_unit([key], seed)
    test = df.filter(hash_unit([key], seed + 1) < 0.3)
    pool = df.filter(hash_unit([key], seed + 1) >= 0.3)
    rows = []
    for f in fractions:
        part = pool.filter(at < f)
        model = estimator.fit(part)
        errors = [1 - accuracy(model.transform(d), label) for d in (part, test)]
        rows.append((float(f), part.count(), *map(float, errors)))
    return df.sparkSession.createDataFrame(rows, "fraction double, rows long, train_error double, test_error double")


# --- choice of features -----------------------------------------------------------------------


def importance(df: DataFrame, columns: Sequence[str], label: str = "label", noise: int = 2, seed: int = 0) -> DataFrame:
    """(feature, importance, above_noise): forest importances against random columns."""
    noisy = written(add_noise(df, noise, seed), "noise") if noise else df
    names = [*columns, *[f"random_{i + 1}" for i in range(noise)]]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(noisy)
    found = random_forest(vectors, label, seed=seed).featureImportances.toArray()
    floor = max(found[len(columns):], default=0.0)
    rows = [(n, float(v), bool(v > floor)) for n, v in zip(names, found)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, above_noise boolean")


def rfe(df: DataFrame, columns: Sequence[str], label: str = "label", keep: int | None = None, seed: int = 0) -> list[str]:
    """Recursive elimination: drop the least important feature until ``keep`` (half) are left."""
    left = list(columns)
    keep = keep if keep is not None else max(1, len(left) // 2)
    while len(left) > keep:
        vectors = VectorAssembler(inputCols=left, outputCol="features").transform(df)
        found = random_forest(vectors, label, trees=10, seed=seed).featureImportances.toArray()
        left.pop(int(found.argmin()))
    return left


def _held_out_f1(df: DataFrame, columns: Sequence[str], estimator: Estimator, key: str, label: str, seed: int) -> float:
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)
    test = hash_unit([key], seed) < 0.3
    predicted = estimator.fit(vectors.filter(~test)).transform(vectors.filter(test))
    return float(binary_metrics(predicted, label).first()["f1"] or 0.0)


def forward_select(df: DataFrame, columns: Sequence[str], estimator: Estimator, key: str, n: int = 3, label: str = "label", seed: int = 0) -> DataFrame:
    """(step, feature, f1): greedily add the feature that helps most, n times."""
    chosen: list[str] = []
    rows = []
    for step in range(n):
        scores = [(_held_out_f1(df, [*chosen, c], estimator, key, label, seed), c) for c in columns if c not in chosen]
        score, best = max(scores, key=lambda s: (s[0], [-ord(ch) for ch in s[1]]))
        chosen.append(best)
        rows.append((step + 1, best, score))
    return df.sparkSession.createDataFrame(rows, "step int, feature string, f1 double")


def add_features_eval(df: DataFrame, columns: Sequence[str], estimator: Estimator, key: str, label: str = "label", seed: int = 0) -> DataFrame:
    """(n, feature, f1): F1 with the first 1, 2, ... features."""
    rows = [
        (i + 1, c, _held_out_f1(df, columns[: i + 1], estimator, key, label, seed)) for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, "n int, feature string, f1 double")


# --- reading a model --------------------------------------------------------------------------


def partial_dependence(model: Model, df: DataFrame, feature: str, grid: Sequence[float], score: str = "probability") -> DataFrame:
    """(value, mean_score, rows): mean prediction with one feature set to each grid value.

    The grid is a short literal list, exploded per row; averages combine before the shuffle.
    """
    spread = model.transform(with_grid(df, feature, grid))
    value = vector_to_array(score)[1] if score == "probability" else F.col(score)
    return spread.groupBy(F.col(feature).alias("value")).agg(F.avg(value).alias("mean_score"), F.count(F.lit(1)).alias("rows"))


def positive_probability(predicted: DataFrame, name: str = "score") -> DataFrame:
    """Add the probability of class 1."""
    return predicted.withColumn(name, vector_to_array("probability")[1])


def model_auc(predicted: DataFrame, label: str = "label") -> DataFrame:
    """AUC of the probability of class 1, by the operator of ``evaluate``."""
    return auc(positive_probability(predicted), label, "score")
