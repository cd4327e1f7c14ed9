"""The rule ensemble: held-out accuracy, the compiled expression against a plain walk, and odd rows."""

import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tabloom.llm import quality
from tabloom.llm.queries import QUERIES


def plain(text):
    """The statistics of a text in plain Python."""
    words, lines = text.split(), text.split("\n")
    share = lambda a, b: a / b if b else 0.0
    solid, letters = sum(map(len, words)), sum(c.isalpha() for c in text)
    return {
        "log_words": math.log1p(len(words)), "word_length": share(solid, len(words)), "letters": share(letters, solid),
        "capitals": share(sum(c.isupper() for c in text), letters), "digits": share(sum(c.isdigit() for c in text), solid),
        "symbols": share(len(re.sub(r"[\w\s.,;:'\"()?-]+", "", text)) + text.count("_"), solid),
        "mark_runs": share(len(re.findall(r"(?:_|[^\w\s]){2,}", text)), len(words)),
        "sentence_ends": share(len(re.findall(r"[.?!](?!\S)", text)), len(words)),
        "distinct_words": share(len(set(words)), len(words)), "distinct_lines": share(len(set(lines) - {""}), len(lines)),
        "words_a_line": share(len(words), len(lines)), "repeats": share(len(re.findall(r"(?<!\S)(\S+)\s+\1(?!\S)", text)), len(words)),
        "links": share(len(re.findall(r"https?://|www\.", text)), len(words)),
    }


@pytest.fixture(scope="module")
def fitted(spark):
    folder = "/root/testdata/sf0.1"
    return quality.fit(*(spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op12_quality_rules"](spark, folder)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    got = got.toPandas()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out].merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    good, bad = held[held.quality == 1], held[held.quality == 0]
    ranks = held.score.rank()
    auc = (ranks[held.quality == 1].sum() - len(good) * (len(good) + 1) / 2) / (len(good) * len(bad))
    assert auc > 0.99 and good.predicted.mean() > 0.98 and bad.predicted.mean() < 0.05


def test_compiled_rules_against_a_plain_walk(spark, fitted, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()] + ["", "a", " lead and trail \n\n", "ab ab ab cd cd"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.score(df, fitted).collect():
        stats = plain(texts[r.doc_id])
        for name, value in stats.items():
            assert r[name] == pytest.approx(value, abs=1e-12), (name, texts[r.doc_id][:80])
        total = fitted.bias
        for rule, weight in fitted.rules:
            if all((r[n] <= b) if most else (r[n] > b) for n, most, b in rule.conditions):
                total += weight
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)
    assert 0 < len(fitted.rules) < 120 and all(w for _, w in fitted.rules)
    assert all(1 <= len(rule.conditions) <= 2 * quality.DEPTH for rule, _ in fitted.rules)


def test_odd_rows(spark, fitted, odd, none):
    got = quality.score(odd, fitted).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (0, 1)}) == 1  # null and empty texts
    assert quality.score(none, fitted).count() == 0
    clashing = odd.withColumn("score", F.lit("x")).withColumn("links", F.lit(1)).withColumn("_text", F.lit(2))
    assert quality.keep_good(clashing, fitted, 0.0).columns == clashing.columns and quality.keep_good(clashing, fitted, 0.0).count() == odd.count()
    assert quality.keep_good(odd, fitted, 1.1).count() == 0
    assert quality.score(clashing, fitted).count() == odd.count()


def test_labels_of_one_kind_and_none(spark, odd):
    labels = spark.createDataFrame([(i, 1) for i in range(9)] + [(None, 0), (3, None)], "doc_id long, quality int")
    assert quality.fit(odd, labels).rules == []
    assert {round(r.score, 6) for r in quality.score(odd, quality.fit(odd, labels)).collect()} != {0.5}
    assert {r.score for r in quality.score(odd, quality.fit(odd, labels.limit(0))).collect()} == {0.5}


def test_held_out_rows_teach_nothing(spark):
    """Labels of the held-out fifth may be anything."""
    docs = spark.range(400).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'bad!! bad!! bad!!' ELSE concat('good words here ', id) END AS text")
    right = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    wrong = right.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, right), quality.fit(docs, wrong)
    assert a.rules and [rule for rule, _ in a.rules] == [rule for rule, _ in b.rules]
    assert [w for _, w in a.rules] == pytest.approx([w for _, w in b.rules]) and a.bias == pytest.approx(b.bias)
