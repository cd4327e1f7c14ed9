"""Evaluation of classifiers from a table of scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.plans import with_position


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion counts and the measures built on them, in one pass. An empty denominator gives null."""
    yes, said = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(yes & said).alias("tp"),
        F.count_if(~yes & said).alias("fp"),
        F.count_if(~yes & ~said).alias("tn"),
        F.count_if(yes & ~said).alias("fn"),
    )

    def share(top, bottom):
        return top / F.nullif(bottom, F.lit(0))

    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        "tp", "fp", "tn", "fn",
        share(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(tn, tn + fp).alias("specificity"),
        share(tn, tn + fn).alias("npv"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score, from high to low: positives and negatives at it, and above or at it.

    Rows are counted per score before the sort; the running sums come from a distributed sort,
    so a long list of scores never meets in one task.
    """
    at = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return with_position(at, [F.desc("score")], "place", {"pos_upto": F.col("pos"), "neg_upto": F.col("neg")})


def _totals(df: DataFrame, label: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    return row["p"], row["n"]


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, tpr, fpr): the rates of calling positive whatever scores strictly above."""
    positives, negatives = _totals(df, label)
    points = score_counts(df, label, score)
    return points.select(
        "score",
        ((F.col("pos_upto") - F.col("pos")) / positives).alias("tpr"),
        ((F.col("neg_upto") - F.col("neg")) / negatives).alias("fpr"),
    )


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the curve by trapezoids; equal scores make one sloped step."""
    positives, negatives = _totals(df, label)
    points = score_counts(df, label, score)
    area = F.sum(F.col("neg") * (F.col("pos_upto") - F.col("pos") / 2.0))
    return points.agg((area / (float(positives) * negatives)).alias("auc"))


def best_threshold(df: DataFrame, alpha: float, beta: float, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, balance) maximising ``-alpha (TP + FP) + 100 beta TP``; the smallest on a tie."""
    points = score_counts(df, label, score)
    tp, fp = F.col("pos_upto") - F.col("pos"), F.col("neg_upto") - F.col("neg")
    balance = -alpha * (tp + fp) + beta * tp * 100
    valued = points.select("score", F.round(balance, 9).alias("balance"))
    best = F.max(F.struct("balance", (-F.col("score")).alias("low")))
    return valued.agg(best.alias("b")).select((-F.col("b.low")).alias("threshold"), F.col("b.balance").alias("balance"))


def group_fairness(df: DataFrame, group: str, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """Per group: size, mean score, outcome rate, share called positive, false-positive and
    false-negative rates at the threshold."""
    said, yes = F.col(score) > threshold, F.col(label) == 1
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"),
        F.avg(yes.cast("double")).alias("outcome_rate"),
        F.avg(said.cast("double")).alias("called_rate"),
        F.avg(F.when(~yes, said.cast("double"))).alias("false_positive_rate"),
        F.avg(F.when(yes, (~said).cast("double"))).alias("false_negative_rate"),
    )
