"""Quality by a sparse ensemble of rules over text statistics.

Boosted trees are grown over the statistics of labelled texts; every path from a root to a node is a
conjunctive rule. A logistic regression with an L1 penalty weighs the rules and drops most of them, and the
rest become one Spark column expression, so that scoring runs without any model object or Python worker.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import text_of
from tabloom.plans.storage import written

#: Labelled rows to learn from, at most.
SAMPLE = 20_000
TREES, DEPTH, PENALTY = 12, 3, 5e-4
#: A rule that holds on fewer (or on all but fewer) rows of the sample is no rule.
LEAST_SUPPORT = 5


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a whole text; all are 0 for an empty one.

    Each is a share or a mean, so that they mean the same for short and long texts, but for ``log_words``.
    """
    found = lambda pattern: F.regexp_count(text, F.lit(pattern))
    kept = lambda others: F.length(F.regexp_replace(text, others, ""))
    share = lambda part, whole: F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    distinct = lambda parts: F.size(F.array_distinct(parts)) - F.array_contains(parts, "").cast("int")
    words, lines = F.split(text, r"\s+"), F.split(text, "\n")
    n_words = F.size(words) - (F.element_at(words, 1) == "").cast("int") - ((F.element_at(words, -1) == "") & (F.size(words) > 1)).cast("int")
    n_lines, solid, letters = F.size(lines), kept(r"\s+"), kept(r"\P{L}+")
    return {
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": share(solid, n_words),
        "letters": share(letters, solid),
        "capitals": share(kept(r"\P{Lu}+"), letters),
        "digits": share(kept(r"\P{Nd}+"), solid),
        "symbols": share(kept(r"[\p{L}\p{N}\s.,;:'\"()?-]+"), solid),
        "mark_runs": share(found(r"[^\p{L}\p{N}\s]{2,}"), n_words),
        "sentence_ends": share(found(r"[.?!](?!\S)"), n_words),
        "distinct_words": share(distinct(words), n_words),
        "distinct_lines": share(distinct(lines), n_lines),
        "words_a_line": share(n_words, n_lines),
        "repeats": share(found(r"(?<!\S)(\S+)\s+\1(?!\S)"), n_words),
        "links": share(found(r"https?://|www\."), n_words),
    }


@dataclass(frozen=True)
class Rule:
    """All of ``conditions`` (statistic, whether at most, bound) hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, at_most, bound in self.conditions:
            out = out & ((F.col(name) <= bound) if at_most else (F.col(name) > bound))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'<=' if most else '>'} {b:.6g}" for n, most, b in self.conditions)


@dataclass
class RuleModel:
    """The weight of every rule that the lasso kept."""

    bias: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        """The score, over the columns of ``statistics``."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def path_rules(root, names: list[str]) -> list[Rule]:
    """A rule for every node below the root of a fitted tree, repeated bounds of a statistic drawn together."""
    rules, todo = [], [(root, ())]
    while todo:
        node, path = todo.pop()
        if path:
            tight: dict[tuple[str, bool], float] = {}
            for name, most, bound in path:
                old = tight.get((name, most), bound)
                tight[name, most] = min(old, bound) if most else max(old, bound)
            rules.append(Rule(tuple(sorted((n, m, b) for (n, m), b in tight.items()))))
        if node.getClass().getSimpleName() == "InternalNode":
            name, bound = names[node.split().featureIndex()], node.split().threshold()
            todo.append((node.leftChild(), (*path, (name, True, bound))))
            todo.append((node.rightChild(), (*path, (name, False, bound))))
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int) -> DataFrame:
    """``label`` and the statistics of at most ``sample`` labelled documents outside the held-out fifth.

    The labelled keys are chosen by a hash. A key with several labels counts as good if one says so.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key)).select(key, F.col(label).cast("double").alias("_label"))
    known = known.orderBy(F.xxhash64(key), key).limit(sample).groupBy(key).agg(F.max("_label").alias("_label"))
    rows = docs.select(F.col(key).alias(key), text_of(text).alias("_text")).join(F.broadcast(known), key)  # bounded by ``sample``
    return rows.select(F.col("_label").alias("label"), *(c.alias(n) for n, c in statistics(F.col("_text")).items()))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY,
) -> RuleModel:
    """Learn rules and weights from labelled rows outside the held-out fifth; only texts and labels are read.

    With one kind of label there are no rules, and every score is that kind's share, smoothed; without
    labels it is a half.
    """
    rows = written(labelled_statistics(docs, labels, key, text, label, sample), "quality-sample")
    names = [c for c in rows.columns if c != "label"]
    n, good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if good in (0, n):
        return RuleModel(math.log((good + 0.5) / (n - good + 0.5)), [])
    data = rows.select("label", array_to_vector(F.array(*names)).alias("features"))
    grown = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=64, stepSize=0.3, seed=12, minInstancesPerNode=3).fit(data)
    rules = sorted({r for tree in grown.trees for r in path_rules(tree._call_java("rootNode"), names)}, key=str)
    support = rows.agg(*(F.sum(r.column().cast("int")).alias(str(i)) for i, r in enumerate(rules))).first() if rules else []
    kept = [r for r, s in zip(rules, support, strict=True) if LEAST_SUPPORT <= s <= n - LEAST_SUPPORT] or rules
    if not kept:
        return RuleModel(math.log((good + 0.5) / (n - good + 0.5)), [])
    held = rows.select("label", array_to_vector(F.array(*(r.column().cast("double") for r in kept))).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100, tol=1e-7).fit(written(held.select("label", "features"), "quality-rules"))
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), [(r, float(w)) for r, w in zip(kept, weights, strict=True) if w])


def score(docs: DataFrame, model: RuleModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` and the statistics of every whole text.

    Null texts count as empty; these have statistics of 0 and a score like any other. Repeated rows score
    alike. Other columns, lang and source among them, are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    rows = rows.select("_key", *(c.alias(n) for n, c in statistics(F.col("_text")).items()))
    return rows.select(F.col("_key").alias(key), model.score().alias("score"), *(c for c in rows.columns if c != "_key"))


def keep_good(docs: DataFrame, model: RuleModel, least: float, text: str = "text") -> DataFrame:
    """The rows whose text scores ``least`` or more, with all their columns."""
    row = F.struct(*(F.col(c) for c in docs.columns))
    rows = docs.select(row.alias("_row"), *(c.alias(n) for n, c in statistics(text_of(text)).items()))
    return rows.filter(model.score() >= least).select(*(F.col("_row")[c].alias(c) for c in docs.columns))
