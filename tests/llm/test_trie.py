"""The conversation trie: against its SQL and against a brute-force trie, in blocks of any size, on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import trie
from tabloom.llm.queries import ORACLES, QUERIES
from tools.check_queries import connect

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """{(conv, depth): (parent, members, children, leaves, saved, digest)} by plain dictionaries."""
    said = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            said.setdefault(conv, []).append((turn is not None, turn or 0, role, digest, text))
    whole = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in said.items()}
    built = {}
    for c in whole:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = whole.get(base, [])[:h] + whole[c][h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {k: [] for k in nodes}
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved, out = {}, {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        saved[k] = own + sum(saved[x] for x in kids[k])
        ends = ",".join(str(c) for c in sorted(nodes[k]) if len(built[c]) == len(k))
        parent = min(nodes[k[:-1]]) if k else None
        out[min(nodes[k]), len(k)] = (parent, len(nodes[k]), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest())
    return out


def built_trie(df, block=trie.BLOCK, last=trie.LAST):
    conv = F.col("conv")
    turns, convs = trie.share_heads(trie.ordered_turns(df), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, 3)
    return trie.prefix_trie(turns, convs, block, last).collect()


def agree(got, rows):
    found = {(r.conv, r.depth): (r.parent, r.n, r.children, r.leaves, r.saved, r.sha) for r in got}
    assert len(found) == len(got) and found == brute(rows)
    assert sorted([r.enter for r in got] + [r.leave for r in got]) == list(range(2 * len(got)))


def test_query_against_sql(spark, small):
    for folder in (small, "/root/testdata/sf0.01"):
        got = QUERIES["op11_conversation_trie"](spark, folder)
        want = connect(folder).sql(ORACLES["op11_conversation_trie"])
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def odd_rows():
    rng, rows = random.Random(5), []
    for conv in [*range(140), -3, -25, 1000]:
        if conv % 17 != 3:
            for turn in range(rng.choice([1, 1, 2, 3, 4, 9])):
                rows.append((conv, rng.choice([None, turn, turn]), rng.choice([None, "user"]), rng.choice(["a", "a b", "", None, "c  d\te"])))
    rows += [(7, i, "user", "one conversation with most of all rows") for i in range(700)]  # hot, and repeated rows below
    return rows + rows[:20] + [(None, 0, "user", "of no conversation"), (139, 5, "", "x" * 300_000)]


@pytest.mark.parametrize("sizes", [(65_536, 262_144, 10_000, 4096), (13, 5, 7, 50)])
def test_odd_rows_in_blocks_of_any_size(spark, monkeypatch, sizes):
    """Small blocks: pieces of the tour are merged over many rounds, long conversations and families are cut."""
    block, last, batch, chunk = sizes
    monkeypatch.setattr(trie, "CHUNK", chunk)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        agree(built_trie(spark.createDataFrame(odd_rows(), TURNS), block, last), odd_rows())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)


def test_one_text_by_all_and_no_rows(spark):
    same = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3)]
    clashing = spark.createDataFrame(same, TURNS).selectExpr("*", "conv_id AS conv", "turn AS pos", "text AS digest", "1 AS words")
    agree(built_trie(clashing), same)
    assert built_trie(spark.createDataFrame([], TURNS)) == []
    assert built_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)) == []


def test_chase():
    before = np.array([-1, 0, 1, -1, 3])
    head, sums = trie.chase(before, np.array([[1], [2], [3], [4], [5]]))
    assert head.tolist() == [0, 0, 0, 3, 3] and sums.ravel().tolist() == [0, 1, 3, 0, 4]
