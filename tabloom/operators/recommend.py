"""Recommenders, similarities, association rules and their evaluation.

Ratings are long tables ``(user_id, item_id, rating)`` with one row per pair. Recommendations
are ``(user_id, item_id, rank)``. Pair work goes through ``pair_sums`` and ``block_product``,
which meet rows block by block instead of joining a popular key with itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import FMRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.aggregates import segment_users
from tabloom.operators.topn import first_unseen
from tabloom.plans import block_product, nearest_neighbours, pair_sums, percentile_within, top_products, with_position, written
from tabloom.plans.blocks import batches, frame, meeting, packed, value_type
from tabloom.plans.sketch import asked_products, singular_vectors

# --- without personalisation ----------------------------------------------------------------


def recommend_random(ratings: DataFrame, n: int = 5, seed: int = 0) -> DataFrame:
    """n items per user drawn with replacement, each with a uniform score from 1 to 5."""
    items = written(with_position(ratings.select("item_id").distinct(), ["item_id"], "_pos"), "items")
    total = items.count()
    draws = ratings.select("user_id").distinct().withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(n))))
    draws = draws.withColumn("_pos", F.floor(F.rand(seed) * total) + 1).withColumn("score", 1 + 4 * F.rand(seed + 1))
    return draws.join(items, "_pos").select("user_id", "item_id", "rank", "score")


def _same_for_all(ratings: DataFrame, ranked: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n items of a ranking, for every user. n is the length of a list, so it is short."""
    top = [r["item_id"] for r in ranked.orderBy(*order).limit(n).select("item_id").collect()]
    lists = ratings.select("user_id").distinct()
    return lists.select("user_id", F.posexplode(F.array(*[F.lit(t) for t in top])).alias("_at", "item_id")).select(
        "user_id", "item_id", (F.col("_at") + 1).alias("rank")
    )


def recommend_popular(ratings: DataFrame, n: int = 5, remove_seen: bool = True) -> DataFrame:
    """Most rated items; ties by id."""
    counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.col("item_id")]
    return first_unseen(ratings, counts, order, n) if remove_seen else _same_for_all(ratings, counts, order, n)


def recommend_top_rated(ratings: DataFrame, n: int = 5, min_count: int = 1, remove_seen: bool = False) -> DataFrame:
    """Highest mean rating among items with enough ratings; ties by id."""
    means = ratings.groupBy("item_id").agg(F.round(F.avg("rating"), 9).alias("mean"), F.count(F.lit(1)).alias("n"))
    means = means.filter(F.col("n") >= min_count)
    order = [F.desc("mean"), F.col("item_id")]
    return first_unseen(ratings, means, order, n) if remove_seen else _same_for_all(ratings, means, order, n)


# --- association ----------------------------------------------------------------------------


def item_support(baskets: DataFrame) -> DataFrame:
    """(item, n, support) from ``(basket, item)``."""
    distinct = baskets.distinct()
    total = baskets.select("basket").distinct().agg(F.count(F.lit(1))).scalar()
    counts = distinct.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("support", F.col("n") / total)


def associations(baskets: DataFrame) -> DataFrame:
    """(x, y, n_xy, confidence, ratio, lift) for all ordered pairs of items bought together.

    confidence is P(y|x); ratio is P(y|x) / P(y|not x), 0 when y never comes without x;
    lift is P(x,y) / (P(x) P(y)).
    """
    baskets = written(baskets.select("basket", "item").distinct(), "baskets")
    pairs = pair_sums(baskets.withColumn("_one", F.lit(1.0)), "item", "basket", "_one", wanted=["n"])
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("x"), F.col("b").alias("y"), "n"),
        F.struct(F.col("b").alias("x"), F.col("a").alias("y"), "n"),
    )).alias("p")).select("p.x", "p.y", F.col("p.n").alias("n_xy"))
    support = written(item_support(baskets), "support")
    total = baskets.select("basket").distinct().count()
    x = support.select(F.col("item").alias("x"), F.col("n").alias("n_x"))
    y = support.select(F.col("item").alias("y"), F.col("n").alias("n_y"))
    joined = both.join(x, "x").join(y, "y")
    confidence = F.col("n_xy") / F.col("n_x")
    without = F.col("n_y") - F.col("n_xy")
    ratio = F.when(without == 0, F.lit(0.0)).otherwise(
        confidence / F.nullif(without / F.nullif(total - F.col("n_x"), F.lit(0)), F.lit(0.0))
    )
    return joined.select(
        "x", "y", "n_xy",
        confidence.alias("confidence"),
        ratio.alias("ratio"),
        ((F.col("n_xy") / total) / (F.col("n_x") / total * (F.col("n_y") / total))).alias("lift"),
    )


def top_associated(pairs: DataFrame, by: str, n: int) -> DataFrame:
    """The n best partners of each item by one of the three measures."""
    order = Window.partitionBy("x").orderBy(F.desc(F.round(by, 9)), "y")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def fit_rules(baskets: DataFrame, min_support: float, min_confidence: float = 0.0):
    """An FP-growth model over ``(basket, item)``.

    Items below the support cannot be in a frequent set, so they leave the lists first (the
    basket stays, if empty). A list then holds at most (items per basket) / min_support items.
    """
    return _fit_lists(*_basket_lists(baskets), min_support, min_confidence)


def _basket_lists(baskets: DataFrame) -> tuple[DataFrame, int]:
    """(basket, items without repeats), and how many there are. One shuffle of the rows serves all that follows."""
    lists = written(baskets.groupBy("basket").agg(F.collect_set("item").alias("items")), "baskets")
    return lists, lists.count()


def _fit_lists(lists: DataFrame, total: int, min_support: float, min_confidence: float):
    counts = lists.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.filter(F.col("n") / total >= min_support).select("item", F.lit(True).alias("_in"))
    rows = lists.select("basket", F.explode_outer("items").alias("item")).join(frequent, "item", "left")
    kept = rows.groupBy("basket").agg(F.collect_set(F.when(F.col("_in"), F.col("item"))).alias("items"))
    return FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(kept)


def frequent_itemsets(baskets: DataFrame, min_support: float) -> DataFrame:
    """(items sorted, n, support) of every itemset at or over the support."""
    lists, total = _basket_lists(baskets)
    sets = _fit_lists(lists, total, min_support, 0.0).freqItemsets
    return sets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n"), (F.col("freq") / total).alias("support"))


def assoc_rules(baskets: DataFrame, min_support: float, threshold: float, method: str = "confidence") -> DataFrame:
    """Rules with one item on the right, at or over the threshold of confidence or lift."""
    rules = fit_rules(baskets, min_support, threshold if method == "confidence" else 0.0).associationRules
    kept = rules.filter(F.col(method) >= threshold)
    return kept.select(
        F.array_sort("antecedent").alias("antecedent"), F.col("consequent")[0].alias("consequent"), "confidence", "lift"
    )


# --- similarity -----------------------------------------------------------------------------


def _both_ways(pairs: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """Symmetric (a, b, value) from pairs a < b, in one pass."""
    return pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias(a), F.col("b").alias(b), F.col(value)),
        F.struct(F.col("b").alias(a), F.col("a").alias(b), F.col(value)),
    )).alias("p")).select("p.*")


def user_sim_euclid(ratings: DataFrame, min_common: int = 1, row: str = "user_id", col: str = "item_id") -> DataFrame:
    """(a, b, sim) with ``1 / (1 + distance)`` over shared items; pairs below the minimum are 0
    and left out."""
    sums = pair_sums(ratings, row, col, "rating", min_common=max(2, min_common), wanted=["sum_aa", "sum_bb", "sum_ab"])
    square = F.col("sum_aa") + F.col("sum_bb") - 2 * F.col("sum_ab")
    return sums.select("a", "b", (1 / (1 + F.sqrt(F.greatest(square, F.lit(0.0))))).alias("sim"))


def user_sim_pearson(ratings: DataFrame, min_common: int = 1, row: str = "user_id", col: str = "item_id") -> DataFrame:
    """(a, b, sim) with the correlation over shared items. Undefined and negative ones are 0
    and left out, as they carry no weight."""
    sums = pair_sums(ratings, row, col, "rating", min_common=max(2, min_common))
    n = F.col("n")
    cross = n * F.col("sum_ab") - F.col("sum_a") * F.col("sum_b")
    var_a = n * F.col("sum_aa") - F.col("sum_a") * F.col("sum_a")
    var_b = n * F.col("sum_bb") - F.col("sum_b") * F.col("sum_b")
    kept = sums.filter((var_a > 1e-9) & (var_b > 1e-9) & (cross > 0))
    return kept.select("a", "b", (cross / (F.sqrt(var_a) * F.sqrt(var_b))).alias("sim"))


def cosine_sim(table: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """(a, b, sim): cosine of two sparse rows over all their columns."""
    sums = pair_sums(table, row, col, value, wanted=["sum_ab"]).select("a", "b", "sum_ab")
    norms = table.groupBy(row).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("_norm"))
    a = norms.select(F.col(row).alias("a"), F.col("_norm").alias("_na"))
    b = norms.select(F.col(row).alias("b"), F.col("_norm").alias("_nb"))
    return sums.join(a, "a").join(b, "b").select("a", "b", (F.col("sum_ab") / (F.col("_na") * F.col("_nb"))).alias("sim"))


def similar_docs(weights: DataFrame, key: str, k: int = 1) -> DataFrame:
    """(doc, near, sim, rank): the k most similar documents by TF-IDF rows of length 1."""
    best = top_products(weights, key, "term", "weight", k)
    return best.select(F.col("a").alias("doc"), F.col("b").alias("near"), F.col("score").alias("sim"), "rank")


# --- neighbourhood predictions --------------------------------------------------------------


def _rating_matrix(ratings: DataFrame, inner: str, outer: str) -> DataFrame:
    return ratings.select(
        F.col(inner).alias("k"), F.col(outer).alias("j"), F.col("rating").cast("double").alias("rated"), F.lit(1.0).alias("has")
    )


def _weighted_means(sims: DataFrame, ratings: DataFrame, inner: str, outer: str, only: DataFrame) -> DataFrame:
    """(i, j, score): mean rating of j's by k's, weighted by sim(i, k), for the pairs (i, j) of ``only``."""
    weights = _both_ways(sims, "i", "k", "sim").withColumnRenamed("sim", "a")
    sums = block_product(weights, _rating_matrix(ratings, inner, outer), ["rated", "has"], only=only)
    return sums.filter(F.col("has") > 1e-12).select("i", "j", (F.col("rated") / F.col("has")).alias("score"))


def _similarity(method: str, min_common: int, n, a, b, aa, bb, ab) -> np.ndarray:
    """Similarity matrix from sums over shared items; 0 where undefined, negative or too few."""
    enough = n >= max(2, min_common)
    if method == "euclid":
        return np.where(enough, 1 / (1 + np.sqrt(np.maximum(aa + bb - 2 * ab, 0))), 0.0)
    cross, var_a, var_b = n * ab - a * b, n * aa - a * a, n * bb - b * b
    usable = enough & (cross > 0) & (var_a > 1e-9) & (var_b > 1e-9)
    return np.divide(cross, np.sqrt(var_a * var_b, where=usable, out=np.ones_like(cross)), where=usable, out=np.zeros_like(cross))


class _Totals:
    """Running sums of one block of users over the items seen so far."""

    def __init__(self, entries: pd.DataFrame):
        self.entries = entries
        self.users, self.at = np.unique(entries["user"].to_numpy(), return_inverse=True)
        self.items: np.ndarray | None = None

    def add(self, items: np.ndarray, num: np.ndarray, den: np.ndarray, rows: slice) -> None:
        if self.items is None:
            self.items = items
            self.num, self.den = (np.zeros((len(self.users), len(items))) for _ in range(2))
        every = np.union1d(self.items, items)
        place = np.searchsorted(every, self.items)
        if len(every) > len(self.items):
            grown = [np.zeros((len(self.users), len(every))) for _ in range(2)]
            for new, old in zip(grown, (self.num, self.den), strict=True):
                new[:, place] = old
            self.items, (self.num, self.den) = every, grown
        place = np.searchsorted(every, items)
        self.num[rows, place] += num
        self.den[rows, place] += den

    def scores(self, most: int = 500_000) -> Iterator[pd.DataFrame]:
        step = max(1, most // max(1, 0 if self.items is None else len(self.items)))
        for low in range(0, 0 if self.items is None else len(self.users), step):
            num, den = self.num[low : low + step], self.den[low : low + step]
            r, c = np.nonzero(den > 1e-12)
            yield pd.DataFrame({"user_id": self.users[low + r], "item_id": self.items[c], "score": num[r, c] / den[r, c]})


def _block_scores(method: str, min_common: int, slice_rows: int = 512, slice_cols: int = 2048):
    def dense(frame: pd.DataFrame, at: np.ndarray, rows: int, cols: np.ndarray):
        place = np.searchsorted(cols, frame["item"].to_numpy())
        inside = frame["item"].isin(cols).to_numpy()
        values, has = np.zeros((rows, len(cols))), np.zeros((rows, len(cols)))
        values[at[inside], place[inside]] = frame["rating"].to_numpy()[inside]
        has[at[inside], place[inside]] = 1.0
        return values, has

    def add(own: _Totals, right: pd.DataFrame) -> None:
        """Similarities of a block of users to a block of neighbours, summed over the neighbours' ratings."""
        others, at_r = np.unique(right["user"].to_numpy(), return_inverse=True)
        shared = np.intersect1d(own.entries["item"].to_numpy(), right["item"].to_numpy())
        for first in range(0, len(own.users), slice_rows):
            users = own.users[first : first + slice_rows]
            mine = (own.at >= first) & (own.at < first + len(users))
            left, at_l = own.entries[mine], own.at[mine] - first
            sums = [np.zeros((len(users), len(others))) for _ in range(6)]
            for low in range(0, len(shared), slice_cols):
                cols = shared[low : low + slice_cols]
                va, ha = dense(left, at_l, len(users), cols)
                vb, hb = dense(right, at_r, len(others), cols)
                for total, part in zip(sums, ((ha, hb), (va, hb), (ha, vb), (va * va, hb), (ha, vb * vb), (va, vb)), strict=True):
                    total += part[0] @ part[1].T
            sim = _similarity(method, min_common, *sums)
            sim[users[:, None] == others[None, :]] = 0.0
            items = np.unique(right["item"].to_numpy())
            for low in range(0, len(items), slice_cols):
                cols = items[low : low + slice_cols]
                vb, hb = dense(right, at_r, len(others), cols)
                own.add(cols, sim @ vb, sim @ hb, slice(first, first + len(users)))

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Totals] = {}
        types: dict[str, pa.DataType] = {}
        for part in parts:
            types = {"user_id": value_type(part, "user_j"), "item_id": value_type(part, "item_j"), "score": pa.float64()}
            for at in range(part.num_rows):
                own, other = ({c: f"{c}_{side}" for c in ("user", "item", "rating")} for side in "ji")
                block = part.column("j")[at].as_py()
                if block not in blocks:
                    blocks[block] = _Totals(frame(part, at, own))
                add(blocks[block], frame(part, at, other))
        for block in list(blocks):
            for out in blocks.pop(block).scores():
                yield from batches(out, types)

    return work


#: Sums of a block of users that a task keeps: users by items.
_CELLS = 1 << 23


def cf_scores(
    train: DataFrame, min_common: int = 1, method: str = "pearson", *, left_rows: int = 512, right_rows: int = 4096
) -> DataFrame:
    """(user_id, item_id, score): sum(sim * r) / sum(sim) over the other raters of each item.

    A task keeps a block of users and the sums of each by item, while the blocks of all possible
    neighbours pass by as they are read from files: their similarities are formed and added up over
    the neighbours' ratings at once. Neither the similarities nor partial sums are ever written out,
    and entries are shuffled twice however many blocks there are. Where users are many, blocks of users grow up
    to the size of those of neighbours, as long as their sums fit. The comparisons are quadratic in the users.
    """
    sizes = train.agg(F.approx_count_distinct("user_id").alias("users"), F.approx_count_distinct("item_id").alias("items")).first()
    cores = train.sparkSession.sparkContext.defaultParallelism
    most_rows = max(left_rows, min(right_rows, _CELLS // max(1, sizes["items"])))
    few, many, n_right = (max(1, -(-sizes["users"] // size)) for size in (most_rows, left_rows, right_rows))
    n_left = max(few, min(many, 4 * cores))

    def blocks(n: int, side: str) -> DataFrame:
        entries = train.select(
            F.pmod(F.xxhash64("user_id"), F.lit(n)).cast("int").alias("block"), F.col("user_id").alias("user"),
            F.col("item_id").alias("item"), F.col("rating").cast("double").alias("rating"),
        )
        out = packed(entries, ["block"])
        return out.toDF(side, *[f"{c}_{side}" for c in out.columns[1:]])

    kinds = ", ".join(f"{c} {train.schema[c].dataType.simpleString()}" for c in ("user_id", "item_id"))
    passing, kept = blocks(n_right, "i").coalesce(1), blocks(n_left, "j").repartitionById(n_left, F.col("j"))
    return meeting(passing, kept).mapInArrow(_block_scores(method, min_common), f"{kinds}, score double")


def cf_predict(train: DataFrame, asked: DataFrame, min_common: int = 1, method: str = "pearson") -> DataFrame:
    """Add ``score`` to the asked (user_id, item_id) pairs; the item's mean, then the user's
    mean, stand in where no similar user has rated the item."""
    items = train.groupBy("item_id").agg(F.avg("rating").alias("_item_mean"))
    users = train.groupBy("user_id").agg(F.avg("rating").alias("_user_mean"))
    scored = asked.join(cf_scores(train, min_common, method), ["user_id", "item_id"], "left")
    filled = scored.join(items, "item_id", "left").join(users, "user_id", "left")
    return filled.select(*asked.columns, F.coalesce("score", "_item_mean", "_user_mean").alias("score"))


def cf_topn(train: DataFrame, n: int = 5, min_common: int = 1, method: str = "pearson") -> DataFrame:
    """(user_id, item_id, rank, score): the n best unseen items by predicted rating.

    Pairs without a similar rater fall back to the item's mean. For these only the first n by
    mean can matter, so no full list of user-item pairs is made.
    """
    pairs = ["user_id", "item_id"]
    scored = written(cf_scores(train, min_common, method), "cf-scores")
    means = train.groupBy("item_id").agg(F.avg("rating").alias("score"))
    done = train.select(*pairs).unionByName(scored.select(*pairs))
    rest = first_unseen(done, means, [F.desc(F.round("score", 9)), F.col("item_id")], n).drop("rank").join(means, "item_id")
    fresh = scored.join(train.select(*pairs), pairs, "left_anti")
    return _best_n(fresh.unionByName(rest), n)


def _best_n(scores: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy(F.desc(F.round("score", 9)), "item_id")
    ranked = scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.select("user_id", "item_id", "rank", "score")


def predict_content(train: DataFrame, asked: DataFrame, item_sims: DataFrame) -> DataFrame:
    """Add ``score``: the user's ratings weighted by the similarity of the items' contents."""
    wanted = asked.select(F.col("item_id").alias("i"), F.col("user_id").alias("j"))
    scores = _weighted_means(item_sims, train, "item_id", "user_id", wanted).select(
        F.col("i").alias("item_id"), F.col("j").alias("user_id"), "score"
    )
    users = train.groupBy("user_id").agg(F.avg("rating").alias("_user_mean"))
    out = asked.join(scores, ["user_id", "item_id"], "left").join(users, "user_id", "left")
    return out.select(*asked.columns, F.coalesce("score", "_user_mean").alias("score"))


# --- factor models --------------------------------------------------------------------------


def centred_ratings(train: DataFrame, items: DataFrame) -> DataFrame:
    """(i, k, a): user, item and the rating less the item's mean."""
    return train.join(items.select("item_id", "mean"), "item_id").select(
        F.col("user_id").alias("i"), F.col("item_id").alias("k"), (F.col("rating") - F.col("mean")).alias("a")
    )


def _svd(train: DataFrame, k: int, rounds: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items with mean, centred entries, (k, vec) with the right singular vectors of these)."""
    items = written(train.groupBy("item_id").agg(F.avg("rating").alias("mean")), "item-means")
    centred = written(centred_ratings(train, items), "centred")
    return items, centred, singular_vectors(centred, k, rounds=rounds)[1]


def svd_factors(train: DataFrame, k: int, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """Right singular vectors of the item-mean-centred rating matrix: (items with mean, (item, f, v)).

    Unrated pairs count as zero after centring. The vectors come from a random sketch, so neither the
    items squared nor a dense row ever exist; any number of items will do.
    """
    items, _, vectors = _svd(train, k, rounds)
    return items, vectors.select(F.col("k").alias("item_id"), F.posexplode("vec").alias("f", "v"))


def svd_recommend(train: DataFrame, asked: DataFrame, k: int = 10) -> DataFrame:
    """Add ``score`` from the rank-k rebuild of the centred matrix; an unknown item scores 3.

    The factors of the users are formed where their asked items are scored, and stay there.
    """
    items, centred, vectors = _svd(train, k)
    first = vectors.select(F.size("vec")).first()
    dots = asked_products(centred, vectors, asked.select(F.col("user_id").alias("i"), F.col("item_id").alias("j")), first[0] if first else 1)
    dots = dots.select(F.col("i").alias("user_id"), F.col("j").alias("item_id"), F.col("dot").alias("_dot"))
    out = asked.join(dots, ["user_id", "item_id"], "left").join(items, "item_id", "left")
    score = F.when(F.col("mean").isNull(), F.lit(3.0)).otherwise(F.col("mean") + F.coalesce("_dot", F.lit(0.0)))
    return out.select(*asked.columns, score.alias("score"))


def mf_fit(train: DataFrame, rank: int = 10, reg: float = 0.1, iterations: int = 10, seed: int = 0):
    """Regularised matrix factorisation by alternating least squares.

    Unknown users or items score null and drop out. Checkpoints follow ``spark.checkpoint.dir``.
    """
    als = ALS(
        rank=rank, regParam=reg, maxIter=iterations, seed=seed, userCol="user_id", itemCol="item_id",
        ratingCol="rating", coldStartStrategy="drop", checkpointInterval=5,
    )
    return als.fit(train.select("user_id", "item_id", F.col("rating").cast("float").alias("rating")))


def bias_terms(train: DataFrame, damping: float = 5.0) -> tuple[float, DataFrame, DataFrame]:
    """Overall mean, item offsets and user offsets, shrunk by the damping count."""
    mean = train.agg(F.avg("rating")).first()[0]
    items = train.groupBy("item_id").agg((F.sum(F.col("rating") - mean) / (F.count(F.lit(1)) + damping)).alias("b_i"))
    left = train.join(items, "item_id").withColumn("_r", F.col("rating") - mean - F.col("b_i"))
    users = left.groupBy("user_id").agg((F.sum("_r") / (F.count(F.lit(1)) + damping)).alias("b_u"))
    return mean, items, users


def add_bias(rows: DataFrame, biases) -> DataFrame:
    """Add ``bias = mean + b_u + b_i``; unknown ids count 0."""
    mean, items, users = biases
    joined = rows.join(items, "item_id", "left").join(users, "user_id", "left")
    bias = F.lit(mean) + F.coalesce("b_i", F.lit(0.0)) + F.coalesce("b_u", F.lit(0.0))
    return joined.select(*rows.columns, bias.alias("bias"))


def mf_bias_fit(train: DataFrame, rank: int = 10, reg: float = 0.1, iterations: int = 10, seed: int = 0):
    """Biases first, then factors on what they leave over. Returns (biases, model)."""
    biases = bias_terms(train)
    rest = add_bias(train, biases).withColumn("rating", F.col("rating") - F.col("bias"))
    return biases, mf_fit(rest, rank, reg, iterations, seed)


def mf_bias_predict(asked: DataFrame, biases, model) -> DataFrame:
    model.setColdStartStrategy("nan")
    out = model.transform(add_bias(asked, biases))
    return out.select(*asked.columns, (F.col("bias") + F.nanvl(F.col("prediction"), F.lit(0.0))).alias("score"))


def similar_items(model, k: int = 5) -> DataFrame:
    """(item_id, near, distance, rank): nearest items in factor space."""
    factors = model.itemFactors.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("vec"))
    near = nearest_neighbours(factors, factors, k, skip_self=True)
    return near.select(F.col("query").alias("item_id"), F.col("ref").alias("near"), "distance", "rank")


def fm_fit(train: DataFrame, columns: Sequence[str], label: str = "rating", k: int = 4, iterations: int = 20, seed: int = 0):
    """Factorisation machine over one-hot columns, first and second order terms."""
    codes = [f"_{c}_code" for c in columns]
    hots = [f"_{c}_hot" for c in columns]
    stages = [
        StringIndexer(inputCols=list(columns), outputCols=codes, handleInvalid="keep"),
        OneHotEncoder(inputCols=codes, outputCols=hots, handleInvalid="keep"),
        VectorAssembler(inputCols=hots, outputCol="features"),
        FMRegressor(labelCol=label, factorSize=k, maxIter=iterations, stepSize=0.05, seed=seed),
    ]
    return Pipeline(stages=stages).fit(train)


def recommend_hybrid(train: DataFrame, model_recs: DataFrame, n: int = 25) -> DataFrame:
    """Frequent users get the model's list, the others the popular unseen items."""
    segments = written(segment_users(train), "segments")
    frequent = segments.filter("segment = 'frequent'").select("user_id")
    new = segments.filter("segment = 'new'").select("user_id")
    columns = ["user_id", "item_id", "rank"]
    popular = recommend_popular(train, n).join(new, "user_id", "left_semi").select(*columns)
    chosen = model_recs.filter(F.col("rank") <= n).join(frequent, "user_id", "left_semi").select(*columns)
    return chosen.unionByName(popular)


# --- evaluation -----------------------------------------------------------------------------


def rating_error(predicted: DataFrame, score: str = "score", rating: str = "rating") -> DataFrame:
    """RMSE and MAE."""
    gap = F.col(rating) - F.col(score)
    return predicted.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))


def relevant_fixed(test: DataFrame, threshold: float = 4) -> DataFrame:
    """Items rated at or over a fixed threshold."""
    return test.filter(F.col("rating") >= threshold).select("user_id", "item_id")


def relevant_quantile(test: DataFrame, q: float = 0.85) -> DataFrame:
    """Items at or over the user's own quantile (linear)."""
    limits = percentile_within(test, ["user_id"], "rating", q, "_limit")
    return test.join(limits, "user_id").filter(F.col("rating") >= F.col("_limit")).select("user_id", "item_id")


def user_rank_metrics(recs: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """(user_id, precision, recall, ap) at k. AP divides by min(relevant, recommended).

    Users without a relevant item do not appear; those with one but without a list count zero. A
    list never exceeds k, so the window that counts the hits so far stays small.
    """
    top = recs.filter(F.col("rank") <= k).select("user_id", "item_id", "rank")
    wanted = relevant.select("user_id", "item_id").distinct()
    sizes = wanted.groupBy("user_id").agg(F.count(F.lit(1)).alias("_rel"))
    marked = top.join(sizes, "user_id").join(wanted.withColumn("_hit", F.lit(1)), ["user_id", "item_id"], "left")
    marked = marked.withColumn("_hit", F.coalesce("_hit", F.lit(0)))
    so_far = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gain = F.col("_hit") * F.sum("_hit").over(so_far) / F.col("rank")
    per_user = marked.withColumn("_gain", gain).groupBy("user_id").agg(
        F.sum("_hit").alias("_hits"), F.count(F.lit(1)).alias("_n"), F.sum("_gain").alias("_g")
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return sizes.join(per_user, "user_id", "left").select(
        "user_id",
        zero(F.col("_hits") / F.col("_n")).alias("precision"),
        zero(F.col("_hits") / F.col("_rel")).alias("recall"),
        zero(F.col("_g") / F.least("_rel", "_n")).alias("ap"),
    )


def rank_metrics(recs: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Mean precision, recall and average precision over users."""
    return user_rank_metrics(recs, relevant, k).agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("ap").alias("map"),
        F.count(F.lit(1)).alias("users"),
    )
