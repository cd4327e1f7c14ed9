"""Hot keys: the split paths must give what the plain ones give, and whole results."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabloom.operators import cluster, joins, linalg
from tabloom.operators import recommend as rec
from tabloom.operators import windows as win
from tabloom.operators.topn import first_unseen
from tabloom.plans import (
    KeyedLinks,
    block_product,
    exact_percentiles,
    nearest_neighbours,
    pair_sums,
    percentile_within,
    row_number_within,
    top_products,
    with_position,
)


@pytest.fixture(scope="module")
def ratings(spark):
    """User 0 holds a third of all rows; item 0 is rated by everyone."""
    rng = np.random.default_rng(3)
    pairs = {(0, i): int(rng.integers(1, 6)) for i in range(60)}
    for u in range(1, 13):
        for i in {0, *map(int, rng.integers(0, 60, 10))}:
            pairs[(u, i)] = int(rng.integers(1, 6))
    rows = [(u, i, r, (u * 7 + i * 13) % 50) for (u, i), r in pairs.items()]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating long, ts long").cache()


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_position_and_running_sum(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("k"), F.lit(2).alias("v"))
    out = with_position(df, ["k", "id"], "pos", {"upto": F.col("v")})
    want = df.withColumn("pos", F.row_number().over(Window.orderBy("k", "id")).cast("long")).withColumn("upto", F.col("pos") * 2)
    assert same(out, want)


def test_row_number_hot_path(ratings):
    plain = row_number_within(ratings, ["user_id"], ["ts", "item_id"])
    assert same(plain, row_number_within(ratings, ["user_id"], ["ts", "item_id"], hot_rows=0))


def test_last_n_hot_path(ratings):
    plain = win.last_n(ratings, 3)
    assert same(plain, win.last_n(ratings, 3, hot_rows=0, run_rows=7))
    assert same(plain, win.last_n(ratings, 3, hot_rows=0, run_rows=3))


def test_split_per_user(ratings):
    plain = win.split_per_user(ratings)
    assert same(plain, win.split_per_user(ratings, hot_rows=0))
    for r in plain.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if("for_testing").alias("t")).collect():
        assert r["t"] == math.ceil(0.2 * r["n"])


@pytest.mark.parametrize("fractions", [[0.5], [0.0, 0.05, 0.85, 1.0]])
def test_percentiles(spark, fractions):
    values = [1.0, 1.0, 1.0, 5.0, 2.5, 9.0, 9.0, 3.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    assert exact_percentiles(df, "x", fractions) == pytest.approx(list(np.quantile(values, fractions)))


@pytest.mark.parametrize("fraction", [0.0, 0.33, 0.5, 0.85, 1.0])
def test_percentile_within(ratings, fraction):
    plain = percentile_within(ratings, ["user_id"], "ts", fraction)
    split = percentile_within(ratings, ["user_id"], "ts", fraction, hot_rows=0)
    got = {r["user_id"]: r["percentile"] for r in split.collect()}
    assert got == pytest.approx({r["user_id"]: r["percentile"] for r in plain.collect()})
    values = {}
    for r in ratings.collect():
        values.setdefault(r["user_id"], []).append(r["ts"])
    assert got == pytest.approx({u: float(np.quantile(v, fraction)) for u, v in values.items()})


def test_large_exact_sample(spark):
    df = spark.range(200_500)
    assert win.sample_exact(df, 150_000).distinct().count() == 150_000


@pytest.mark.parametrize("blocks", [{}, {"rows_per_block": 3, "cols_per_chunk": 9}])
def test_pair_sums(ratings, blocks):
    data = {}
    for r in ratings.collect():
        data.setdefault(r["user_id"], {})[r["item_id"]] = r["rating"]
    want = {}
    for a, b in itertools.combinations(sorted(data), 2):
        shared = data[a].keys() & data[b].keys()
        if len(shared) >= 2:
            want[(a, b)] = (len(shared), *(float(sum(f(data[a][i], data[b][i]) for i in shared)) for f in (
                lambda x, y: x, lambda x, y: y, lambda x, y: x * x, lambda x, y: y * y, lambda x, y: x * y)))
    got = {(r["a"], r["b"]): tuple(r)[2:] for r in pair_sums(ratings, "user_id", "item_id", "rating", min_common=2, **blocks).collect()}
    assert got == want


@pytest.mark.parametrize("rows_per_block", [1024, 4])
def test_top_products(ratings, rows_per_block):
    data = {}
    for r in ratings.collect():
        data.setdefault(r["user_id"], {})[r["item_id"]] = r["rating"]
    got = {}
    for r in top_products(ratings, "user_id", "item_id", "rating", 3, rows_per_block=rows_per_block).collect():
        got[(r["a"], r["rank"])] = (r["b"], r["score"])
    for a in data:
        scores = {b: float(sum(v * data[b][i] for i, v in data[a].items() if i in data[b])) for b in data if b != a}
        best = sorted((b for b in scores if scores[b] > 0), key=lambda b: (-scores[b], b))[:3]
        assert [got[(a, n + 1)] for n in range(len(best))] == [(b, scores[b]) for b in best]


@pytest.mark.parametrize("block_rows", [None, 7])
def test_nearest_neighbours(spark, block_rows):
    rng = np.random.default_rng(0)
    points = np.vstack([rng.normal(size=(30, 3)), np.ones((10, 3))])  # ten copies of one point
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "id long, vec array<double>")
    got = {(r["query"], r["rank"]): r["ref"] for r in nearest_neighbours(df, df, 4, skip_self=True, block_rows=block_rows).collect()}
    for q, p in enumerate(points):
        order = sorted((j for j in range(len(points)) if j != q), key=lambda j: (np.sqrt(((points[j] - p) ** 2).sum()), j))
        assert [got[(q, k + 1)] for k in range(4)] == order[:4]


@pytest.mark.parametrize("size", [{}, {"block_rows": 3, "chunk": 4}])
def test_block_product(spark, size):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-2, 3, (7, 11)), rng.integers(-2, 3, (11, 5))
    def long(m, names):
        return spark.createDataFrame([(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])], names)
    out = block_product(long(a, "i long, k long, a double"), long(b, "k long, j long, b double"), **size)
    assert {(r["i"], r["j"]): r["b"] for r in out.collect()} == {(i, j): float((a @ b)[i, j]) for i in range(7) for j in range(5)}


@pytest.mark.parametrize("n", [1, 5, 70])
def test_first_unseen(ratings, n):
    items = ratings.select("item_id").distinct()
    out = first_unseen(ratings, items, [F.desc("item_id")], n)
    got = {}
    for r in out.orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["item_id"])
    seen, every = {}, sorted((r["item_id"] for r in items.collect()), reverse=True)
    for r in ratings.collect():
        seen.setdefault(r["user_id"], set()).add(r["item_id"])
    want = {u: [i for i in every if i not in s][:n] for u, s in seen.items()}
    assert got == {u: w for u, w in want.items() if w}


def test_unseen_of_given_users(ratings):
    out = joins.unseen_items(ratings, [0, 1])
    assert out.filter("user_id = 0").count() == 0
    assert out.count() == 60 - ratings.filter("user_id = 1").count()


def test_keyed_links_split_a_hot_key(spark):
    links = spark.range(100).select(F.when(F.col("id") < 60, 0).otherwise(F.col("id")).alias("src"), F.col("id").alias("dst"))
    kept = KeyedLinks(links, "src", rows_per_part=7)
    values = links.select("src").distinct().withColumn("v", F.col("src") * 10)
    out = kept.send(values)
    assert same(out.select("src", "dst", "v"), links.withColumn("v", F.col("src") * 10))
    assert kept.table.filter("src = 0").select("_part").distinct().count() == 9
    kept.close()


@pytest.fixture(scope="module")
def crowd(spark):
    """A third of the points in one spot (some exact copies), two arcs, stray points."""
    rng = np.random.default_rng(5)
    spot = rng.normal(0, 0.004, (60, 2))
    spot[:15] = 0.001
    arc = [(0.5 + 0.3 * math.cos(t), 0.3 * math.sin(t)) for t in np.linspace(0, 3, 60)]
    stray = rng.uniform(-1, 1, (60, 2))
    points = np.vstack([spot, arc, stray])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id long, x double, y double")
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    return df, distance


@pytest.mark.parametrize("strict", [True, False])
def test_eps(crowd, strict):
    df, distance = crowd
    near = distance < 0.05 if strict else distance <= 0.05
    want = dict(enumerate(near.sum(axis=1)))
    for block_rows in (4096, 6):
        got = cluster.eps_counts(df, ["x", "y"], 0.05, strict, block_rows)
        assert {r["id"]: r["n"] for r in got.collect()} == want
        assert "FlatMapCoGroupsInPandas" in got._jdf.queryExecution().toString() and "count_if" not in got._jdf.queryExecution().toString()
    lost = df.limit(3).selectExpr("id + 1000 AS id", "if(id = 0, null, x) AS x", "if(id = 0, y, null) AS y")
    got = {r["id"]: r["n"] for r in cluster.eps_counts(df.unionByName(lost), ["x", "y"], 0.05, strict, 6).collect()}
    assert got == want | {1000: 0, 1001: 0, 1002: 0}
    pairs = {(r["a"], r["b"]) for r in cluster.eps_pairs(df, ["x", "y"], 0.05, strict).collect()}
    assert pairs == {(a, b) for a in range(180) for b in range(a + 1, 180) if near[a, b]}
    core = {r["id"]: r["core"] for r in cluster.core_points(df, ["x", "y"], 0.05, 6, strict).collect()}
    assert core == {i: bool(n >= 6) for i, n in want.items()}


@pytest.mark.parametrize("eps, min_pts", [(0.05, 4), (0.02, 3), (0.2, 8), (0.001, 2)])
def test_dbscan(crowd, eps, min_pts):
    df, distance = crowd
    near = distance <= eps
    core = near.sum(axis=1) >= min_pts
    label = {}
    for start in range(len(core)):
        if core[start] and start not in label:
            todo = [start]
            while todo:
                p = todo.pop()
                if p not in label:
                    label[p] = start
                    todo += [q for q in range(len(core)) if core[q] and near[p, q]]
    for p in range(len(core)):
        if not core[p]:
            reach = [label[q] for q in range(len(core)) if core[q] and near[p, q]]
            label[p] = min(reach, default=-1)
    got = cluster.dbscan(df, ["x", "y"], eps, min_pts).collect()
    assert {r["id"]: r["label"] for r in got} == label
    assert {r["id"]: r["core"] for r in got} == {i: bool(c) for i, c in enumerate(core)}


def test_components_of_a_long_chain(spark):
    edges = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    nodes = spark.range(45).select(F.col("id").alias("node"))
    got = {r["node"]: r["label"] for r in cluster.connected_components(nodes, edges).collect()}
    assert got == {i: 0 if i <= 40 else i for i in range(45)}


def test_pagerank(spark):
    links = [(0, 1), (0, 2), (1, 2), (2, 0), (3, 2), (4, 5)] + [(i, 2) for i in range(6, 30)]
    out = linalg.pagerank(spark.createDataFrame(links, "src long, dst long"), tol=1e-12, max_iter=200)
    rank = {r["node"]: r["rank"] for r in out.collect()}
    n = 30
    x = np.ones(n) / n
    for _ in range(300):
        y = np.zeros(n)
        for j in range(n):
            out_links = [d for s, d in links if s == j]
            for d in out_links or range(n):
                y[d] += x[j] / len(out_links or range(n))
        x = 0.85 * y + 0.15 / n
    assert sum(rank.values()) == pytest.approx(1)
    assert [rank[i] for i in range(n)] == pytest.approx(list(x), abs=1e-9)


def test_kalman_gains_that_never_settle(spark):
    """Both roots on the unit circle: the gains creep on for ever, across chunks too."""
    y = np.random.default_rng(4).normal(3, 1, 90)
    df = spark.createDataFrame([("a", i, i, float(v)) for i, v in enumerate(y)], "series string, t long, id long, value double")
    got = {r["at"]: r["forecast"] for r in linalg.kalman_ma(df, 2.0, 1.0, chunk_rows=7).collect()}
    shift, r = np.eye(3, k=1), np.array([1.0, 2.0, 1.0])
    m, c = np.zeros(3), np.eye(3) * 1e7
    for at, v in enumerate(y - y.mean(), 1):
        m, c = shift @ m, shift @ c @ shift.T + np.outer(r, r)
        assert got[at] == pytest.approx(m[0] + y.mean(), abs=1e-6)
        gain = c[:, 0] / c[0, 0]
        m, c = m + gain * (v - m[0]), c - np.outer(gain, c[0])


def test_kalman_in_chunks(spark):
    rng = np.random.default_rng(2)
    rows = [("a" if i % 3 else "b", i, i, float(v)) for i, v in enumerate(rng.normal(5, 2, 200))]
    df = spark.createDataFrame(rows, "series string, t long, id long, value double")
    whole = linalg.kalman_ma(df, 0.8504, 0.2416)
    cut = linalg.kalman_ma(df, 0.8504, 0.2416, chunk_rows=7, hot_rows=0)
    a = {(r["series"], r["at"]): r["forecast"] for r in whole.collect()}
    b = {(r["series"], r["at"]): r["forecast"] for r in cut.collect()}
    assert a.keys() == b.keys() and len(a) == 200
    assert all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)
    # The full three-state filter, written out with matrices.
    g, f = np.eye(3, k=1), np.array([1.0, 0, 0])
    r = np.array([1.0, 0.8504, 0.2416])
    y = np.array([v for s, _, _, v in rows if s == "a"])
    m, c = np.zeros(3), np.eye(3) * 1e7
    for t, v in enumerate(y - y.mean()):
        m, c = g @ m, g @ c @ g.T + np.outer(r, r)
        assert a[("a", t + 1)] == pytest.approx(m[0] + y.mean(), abs=1e-6)
        gain = c @ f / (f @ c @ f)
        m, c = m + gain * (v - m[0]), c - np.outer(gain, f @ c)


@pytest.mark.parametrize("by", ["euclid", "pearson"])
def test_user_similarity(ratings, by):
    data = {}
    for r in ratings.collect():
        data.setdefault(r["user_id"], {})[r["item_id"]] = float(r["rating"])
    fn = rec.user_sim_euclid if by == "euclid" else rec.user_sim_pearson
    got = {(r["a"], r["b"]): r["sim"] for r in fn(ratings, 3).collect()}
    for a, b in itertools.combinations(sorted(data), 2):
        shared = sorted(data[a].keys() & data[b].keys())
        x, y = np.array([data[a][i] for i in shared]), np.array([data[b][i] for i in shared])
        want = 0.0
        if len(shared) >= 3:
            if by == "euclid":
                want = 1 / (1 + np.linalg.norm(x - y))
            elif x.std() > 0 and y.std() > 0:
                want = max(0.0, np.corrcoef(x, y)[0, 1])
        assert got.get((a, b), 0.0) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("method", ["pearson", "euclid"])
@pytest.mark.parametrize("sizes", [{}, {"left_rows": 2, "right_rows": 5}])
def test_neighbourhood_scores(ratings, method, sizes):
    """Blocks fused over neighbours against the formula with the pairwise similarities."""
    fn = rec.user_sim_euclid if method == "euclid" else rec.user_sim_pearson
    sims = {}
    for r in fn(ratings, 3).collect():
        sims[(r["a"], r["b"])] = sims[(r["b"], r["a"])] = r["sim"]
    by_item = {}
    for r in ratings.collect():
        by_item.setdefault(r["item_id"], {})[r["user_id"]] = r["rating"]
    want = {}
    for u in range(13):
        for i, raters in by_item.items():
            den = sum(sims.get((u, v), 0.0) for v in raters)
            if den > 1e-12:
                want[(u, i)] = sum(sims.get((u, v), 0.0) * x for v, x in raters.items()) / den
    got = {(r["user_id"], r["item_id"]): r["score"] for r in rec.cf_scores(ratings, 3, method, **sizes).collect()}
    assert got == pytest.approx(want)


def test_null_keys_on_both_paths(spark):
    from tabloom.plans import percentile_within, row_number_within

    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("a", 5.0)], "k string, v double")
    both = [sorted(map(tuple, row_number_within(df, ["k"], ["v"], hot_rows=h).collect()), key=str) for h in (10, 0)]
    assert both[0] == both[1] and len(both[0]) == 4
    both = [sorted(map(tuple, percentile_within(df, ["k"], "v", 0.5, hot_rows=h).collect()), key=str) for h in (10, 0)]
    assert both[0] == both[1] == [("a", 3.5), (None, 2.0)] or sorted(both[0], key=str) == sorted(both[1], key=str)


def test_users_without_ranked_items_or_lists(spark):
    from tabloom.operators import recommend as rec

    ratings = spark.createDataFrame([(1, 10, 5), (2, 10, 4), (1, 11, 3), (2, 11, 3), (3, 99, 5)], "user_id long, item_id long, rating int")
    lists = rec.recommend_top_rated(ratings, 5, 2, remove_seen=True)
    assert sorted((r.user_id, r.item_id, r["rank"]) for r in lists.collect()) == [(3, 10, 1), (3, 11, 2)]
    recs = spark.createDataFrame([(1, 10, 1)], "user_id long, item_id long, rank int")
    relevant = spark.createDataFrame([(1, 10), (2, 10)], "user_id long, item_id long")
    row = rec.rank_metrics(recs, relevant, 5).first()
    assert (row["map"], row["users"]) == (0.5, 2)


def test_tree_takes_many_categories(spark):
    from tabloom.operators import models

    df = spark.range(300).selectExpr("concat('c', id % 100) AS c", "double(id % 7) AS x", "double(id % 2) AS label")
    assert models.tree_classifier(df, ["c"], ["x"]).transform(df).count() == 300


def test_blocks_meet_without_copies(spark, ratings):
    """Blocks that meet are read from files: no plan unfolds an entry once for each block it meets."""
    plans = [
        pair_sums(ratings, "user_id", "item_id", "rating", rows_per_block=3, cols_per_chunk=9),
        top_products(ratings, "user_id", "item_id", "rating", 3, rows_per_block=4),
        rec.cf_scores(ratings, 3, left_rows=2, right_rows=5),
    ]
    for df in plans:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "Join" in plan


def test_counts_alone_are_the_same(ratings):
    """j03 asks for counts only; they and the sums that r12 asks for equal those of a full run."""
    full = pair_sums(ratings, "user_id", "item_id", "rating", min_common=2, rows_per_block=3)
    want = sorted((r["a"], r["b"], r["n"], r["sum_ab"]) for r in full.collect())
    some = pair_sums(ratings, "user_id", "item_id", "rating", min_common=2, rows_per_block=3, wanted=["sum_ab"])
    assert some.columns == ["a", "b", "n", "sum_ab"] and sorted(map(tuple, some.collect())) == want


def test_blocks_of_text_keys(spark):
    """Keys of text, and items that only some blocks of neighbours have rated."""
    rows = [(f"u{u}", f"i{i}", 1 + (u * i) % 5) for u in range(12) for i in range(u % 3, 9 + u % 4)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating int")
    for fn in (
        lambda n: pair_sums(df, "user_id", "item_id", "rating", rows_per_block=n),
        lambda n: top_products(df, "user_id", "item_id", "rating", 3, rows_per_block=n),
        lambda n: rec.cf_scores(df, 3, left_rows=n, right_rows=n),
    ):
        one, many = ({tuple(r)[:2]: tuple(r)[2:] for r in fn(n).collect()} for n in (100, 2))
        assert one.keys() == many.keys() and all(one[k] == pytest.approx(many[k]) for k in one)


def test_genres_move_with_their_ratings(spark):
    """Scaled ratings and thresholds with null ratings, genres and users; nothing is shuffled by user and genre."""
    genres = {1: ["a", "b"], 2: ["a", None], 3: ["b", None, "c"], 4: [], 5: None, 6: ["c", "c"]}
    rows = [(u, i, None if (u, i) == (2, 3) else 1 + ((u or 7) * i) % 5) for u in (1, 2, 3, None) for i in genres if u != 3 or i < 3]
    df = spark.createDataFrame([(u, i, r, genres[i]) for u, i, r in rows], "user_id long, item_id long, rating int, genre array<string>")
    long = [(u, i, r, g) for u, i, r in rows for g in genres[i] or []]
    want_norm, of_user = {}, {}
    for u, i, r, g in long:
        same = [x for v, _, x, h in long if (v, h) == (u, g) and x is not None]
        of_user.setdefault(u, []).append(sum(same) / len(same) if same else None)
        if u is not None and g is not None:
            low, high = min(same), max(same)
            want_norm.setdefault((u, i), []).append(0.0 if low == high else None if r is None else (r - low) / (high - low) * 5)
    want_norm = {k: [x for x in v if x is not None] for k, v in want_norm.items()}
    norm, loved = win.norm_rating(df), win.loved_flag(df)
    got = {(r["user_id"], r["item_id"]): r["norm_rating"] for r in norm.collect()}
    assert got.keys() == want_norm.keys()
    assert got == {k: pytest.approx(sum(v) / len(v)) if v else None for k, v in want_norm.items()}
    got = {(r["user_id"], r["item_id"]): (r["loved"], r["user_threshold"]) for r in loved.collect()}
    assert got.keys() == {(u, i) for u, i, _ in rows if u is not None}
    for u, i, r in rows:
        if u is not None:
            limit = sum(of_user[u]) / len(of_user[u])
            assert got[(u, i)] == (None if r is None else int(r > limit + 1e-9), pytest.approx(limit))
    for out in (norm, loved):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "Exchange" in line and "_genre" in line]


@pytest.mark.parametrize("size", [{}, {"block_rows": 3, "chunk": 4}])
def test_block_product_of_asked_pairs(spark, size):
    """Only asked pairs leave a task, also with ids that a double can't hold; unknown ones and nulls are left out."""
    big, rng = 2**60, np.random.default_rng(2)
    a, b = rng.integers(0, 3, (7, 11)), rng.integers(0, 3, (11, 5))
    def long(m, names):
        cells = [(big + i, big + j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1]) if m[i, j]]
        return spark.createDataFrame(cells, names)
    left, right = long(a, "i long, k long, a double"), long(b, "k long, j long, b double")
    pairs = [(big, big + 1), (big + 3, big), (big, big + 1), (big + 3, big + 4), (big + 99, big), (big, big + 99), (None, big), (big, None)]
    only = spark.createDataFrame(pairs, "i long, j long")
    whole = {(r["i"], r["j"]): r["b"] for r in block_product(left, right, **size).collect()}
    out = block_product(left, right, only=only, **size).collect()
    assert len(out) == 3 and {(r["i"], r["j"]): r["b"] for r in out} == {p: whole[p] for p in set(pairs) if p in whole}
