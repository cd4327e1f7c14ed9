"""User combiners: against plain Python, with hot keys, nulls, and combiners handed on early."""

import math
import operator

from tabloom.operators.udfs import aggregate_by_key


def test_user_combiners(spark):
    rows = [("hot" if i % 3 else f"k{i % 40}", i % 11) for i in range(3000)] + [(None, 4), (None, 5), ("k1", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(7)
    want = {}
    for k, v in rows:
        want.setdefault(k, []).append(v)
    for keys_at_once in (100_000, 5):
        lists = aggregate_by_key(df, "k", "v", lambda v: [v], lambda c, v: [*c, v], lambda a, b: a + b, "array<long>", keys_at_once=keys_at_once)
        got = {r.k: sorted(r.v, key=str) for r in lists.collect()}
        assert got == {k: sorted(v, key=str) for k, v in want.items()}
    known = df.filter("v is not null")
    means = aggregate_by_key(known, "k", "v", lambda v: (v, 1), lambda c, v: (c[0] + v, c[1] + 1), lambda a, b: (a[0] + b[0], a[1] + b[1]), "double", lambda c: c[0] / c[1], fan=2)
    for r in means.collect():
        some = [v for v in want[r.k] if v is not None]
        assert math.isclose(r.v, sum(some) / len(some))
    assert aggregate_by_key(df.limit(0), "k", "v", lambda v: v, max, max, "long").count() == 0


def test_many_keys_stream(spark):
    """Thousands of keys, each in every task, come in whole batches and not one call a key; combiners may change in place."""
    from tabloom.operators import udfs

    df = spark.range(60_000, numPartitions=6).selectExpr("if(id % 5000 = 7, null, id % 5000) AS k", "id AS v")
    lists = udfs.aggregate_by_key(df, "k", "v", lambda v: [v], lambda c, v: operator.iadd(c, [v]), operator.iadd, "array<long>", sorted, keys_at_once=700)
    assert "FlatMapGroupsInPandas" not in udfs.plan_text(lists)
    got = {r.k: r.v for r in lists.collect()}
    assert got == {None if k == 7 else k: list(range(k, 60_000, 5000)) for k in range(5000)}


def test_last_items_in_line(spark):
    from tabloom.operators import windows as win

    df = spark.createDataFrame([(1, i, i % 5, f"n{i}") for i in range(9)] + [(None, 3, 1, "x"), (None, 4, 0, None)], "user_id long, item_id long, ts long, name string")
    for run_rows in (262_144, 2):
        out = win.last_n(df, 2, run_rows=run_rows, more=["name"])
        for r in out.collect():
            before = sorted((x for x in df.collect() if x.user_id == r.user_id and (x.ts, x.item_id) < (r.ts, r.item_id)), key=lambda x: (x.ts, x.item_id), reverse=True)
            assert [r.last_1, r.last_2] == ([x.item_id for x in before] + [0, 0])[:2]
            assert [r.name_1, r.name_2] == ([x.name for x in before] + [None, None])[:2]


def test_itemsets_store_baskets_once(spark, monkeypatch):
    """Repeated rows, null items and null baskets; the baskets are made lists once, and supports and sets come from those."""
    from itertools import combinations

    from tabloom.operators import recommend as rec

    stored = []
    monkeypatch.setattr(rec, "written", lambda df, *more, keep=rec.written: stored.append(1) or keep(df, *more))
    rows = [(b % 20 or None, "abcd"[b * i % 4] if i else None) for b in range(40) for i in range(4)]
    got = {tuple(r["items"]): (r.n, round(r.support, 9)) for r in rec.frequent_itemsets(spark.createDataFrame(rows, "basket long, item string"), 0.3).collect()}
    assert len(stored) == 1
    baskets = {b: {i for x, i in rows if x == b and i} for b, _ in rows}
    sizes = {s: sum(set(s) <= have for have in baskets.values()) for n in range(1, 5) for s in combinations("abcd", n)}
    assert got == {s: (n, round(n / 20, 9)) for s, n in sizes.items() if n >= 0.3 * 20}
