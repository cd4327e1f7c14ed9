"""Literal lines for every parsing and cleaning rule."""

import datetime

import pytest
from pyspark.sql import functions as F

from tabloom.functions import clf, text


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first()["y"]


GOOD = 'in24.example.com - - [01/Aug/1995:00:00:01 -0400] "GET /a/b.txt HTTP/1.0" 200 1839'


@pytest.mark.parametrize(
    "line, fixed, parsed",
    [
        (GOOD, True, True),
        (GOOD, False, True),
        (GOOD.replace('1.0"', '1.0 "'), True, True),
        (GOOD.replace('1.0"', '1.0 "'), False, False),
        (GOOD.replace(" HTTP/1.0", ""), True, True),
        (GOOD.replace("200", "20"), True, False),
        (GOOD.replace("-0400", "0400"), True, False),
        ("nonsense", True, False),
        ("", True, False),
    ],
)
def test_clf_patterns(spark, line, fixed, parsed):
    row = clf.parse_clf(spark.createDataFrame([(line,)], "line string"), fixed=fixed).first()
    assert row["parsed"] is parsed
    if not parsed:
        assert row["host"] is None and row["content_size"] is None and row["date_time"] is None


def test_clf_fields(spark):
    row = clf.parse_clf(spark.createDataFrame([(GOOD,)], "line string")).first()
    assert (row["host"], row["client_identd"], row["user_id"]) == ("in24.example.com", "-", "-")
    assert row["date_time"] == datetime.datetime(1995, 8, 1, 0, 0, 1)  # the offset is ignored
    assert (row["method"], row["endpoint"], row["protocol"]) == ("GET", "/a/b.txt", "HTTP/1.0")
    assert (row["response_code"], row["content_size"]) == (200, 1839)


def test_clf_dash_size_and_report(spark):
    lines = spark.createDataFrame([(GOOD.replace("1839", "-"),), ("broken",), (GOOD,)], "line string")
    parsed = clf.parse_clf(lines)
    assert sorted(r["content_size"] for r in parsed.filter("parsed").collect()) == [0, 1839]
    assert tuple(clf.parse_report(parsed).first()) == (3, 2, 1)


@pytest.mark.parametrize(
    "fn, value, want",
    [
        (text.remove_url, "see https://a.b/c?d=1 or www.x.y now", "see  or  now"),
        (text.remove_emoji, "ok \U0001f600\U0001f680 yes ✂", "ok  yes "),
        (text.remove_html, "<p>a <b>b</b></p> 1 < 2", "a b 1 < 2"),
        (text.remove_html, "<a\nb>", "<a\nb>"),
        (text.remove_punct, "a.b-c_d!e\\f]g", "abcdefg"),
        (text.expand_contractions, "I won't, can't, don't; it's we're he'd I'll I've I'm", "I will not, can not, do not; it is we are he would I will I have I am"),
        (text.normalize_text, "The Cat\\nand \\\"12\\\" Dogs!", "cat 12 dogs"),
        (text.punct_to_words, "Wow! Why?", "Wow exclamation  Why question "),
        (text.extract_label, '<a href="u" rel="n">Phone app</a>', "Phone app"),
        (text.movie_name, "Toy Story (1995)", "Toy Story "),
        (text.movie_year, "2001: A Space (x) Odyssey (1968)", 1968),
        (text.movie_year, "no year", None),
        (text.strip_number, " 12 345.5 ", 12345.5),
        (text.strip_number, ":", None),
    ],
)
def test_cleaning(spark, fn, value, want):
    assert one(spark, value, fn) == want


def test_tokens(spark):
    assert one(spark, "It's a well-known fact: cats, 12 dogs can't u.s. swim. Été!", text.tokenize) == [
        "It", "a", "fact", "cats", "dogs", "ca", "swim", "Été",
    ]
    assert one(spark, "The cat and the dog", lambda c: text.remove_stopwords(F.split(c, " "))) == ["The", "cat", "dog"]


def test_ngrams(spark):
    grams = one(spark, "aa bb cc", lambda c: text.ngrams(text.words(c), 1, 3))
    assert grams == ["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"]
    assert one(spark, "aa", lambda c: text.ngrams(text.words(c), 1, 3)) == ["aa"]
    assert one(spark, "a", lambda c: text.ngrams(text.words(c), 1, 3)) == []
    assert one(spark, "aa bb cc", lambda c: text.ngrams(text.words(c), 2, 2)) == ["aa bb", "bb cc"]


@pytest.mark.parametrize("m", [257, 750])
def test_string_hash(spark, m):
    value, h = "Zürich 中", 0
    for ch in value:
        h = (h * 1024 + ord(ch)) % m
    assert one(spark, value, lambda c: text.string_hash(c, m)) == h
    assert one(spark, "", lambda c: text.string_hash(c, m)) == 0


def test_sentence_vectors_in_blocks(spark):
    """Blocks of documents meet chunks of vectors: no vector is copied for each word of each document."""
    import numpy as np

    from tabloom.operators import features as feat

    rng = np.random.default_rng(2)
    table = {f"w{i}": rng.standard_normal(4) for i in range(50)}
    texts = [(i, " ".join(f"w{j}" for j in rng.integers(0, 70, 12))) for i in range(60)] + [(100, None), (101, ""), (102, "none known"), (3, "w1 w1 w2")]
    docs = spark.createDataFrame(texts, "doc long, text string")
    vectors = spark.createDataFrame([(w, v.tolist()) for w, v in table.items()] + [("w60", None), (None, [1.0] * 4)], "word string, vec array<double>")
    words = {}
    for i, text in texts:
        words.setdefault(i, []).extend(table[w] for w in (text or "").split() if w in table)
    for limits in ({}, {"chunk_words": 7, "most_docs": 9}):
        out = feat.sentence_vectors(docs, "doc", "text", vectors, 4, **limits)
        plan = out._jdf.queryExecution().toString()
        assert "FlatMapCoGroupsInPandas" in plan and "summarizer" not in plan.lower()
        got = out.collect()
        assert sorted(r.doc for r in got) == sorted(i for i, _ in texts)
        for r in got:
            assert np.allclose(r.vec, np.mean(words[r.doc], axis=0) if words[r.doc] else np.zeros(4), atol=1e-12)


def test_words_are_counted_before_they_move(spark):
    """Between the texts and the join by word nothing is shuffled, and sums and copied vectors grow alike."""
    from tabloom.operators import features as feat

    docs = spark.createDataFrame([(1, "a b a"), (2, "b\tc  b b"), (1, "a"), (None, "a"), (3, "")], "doc long, text string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("", [5.0, 5.0])], "word string, vec array<double>")
    out = feat.sentence_vectors(docs, "doc", "text", vectors, 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "count(1)" not in plan
    got = sorted((r.doc is None, r.doc, r.vec) for r in out.collect())
    assert got == [(False, 1, [0.75, 0.25])] * 2 + [(False, 2, [0.0, 1.0]), (False, 3, [5.0, 5.0]), (True, None, [0.0, 0.0])]
    for words in (1 << 16, 1 << 20):
        chunks, parts = feat._blocking(words, 1 << 24, None, None)
        assert words / chunks <= feat.MOST_WORDS and 0.2 < (chunks << 24) / (parts * words) < 5
