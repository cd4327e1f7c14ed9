"""Scratch tables: who owns them, when they go, and that their shuffles go with the write."""

import os

import pytest
from pyspark.sql import functions as F

from tabloom.plans import dropped, scratch, written


def path_of(table):
    return table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")


def test_a_block_deletes_what_it_made_but_what_outlives_it(spark):
    with scratch():
        inner = written(spark.range(5), "inner")
        with scratch():
            deeper = written(inner, "deeper", outlive=True)
        assert deeper.count() == 5
        kept = written(deeper.withColumn("x", F.lit(1)), "kept", outlive=True)
        paths = [path_of(inner), path_of(deeper)]
    assert not any(map(os.path.exists, paths))
    assert kept.count() == 5
    dropped(kept)


def test_a_failed_block_deletes_too(spark):
    with pytest.raises(ZeroDivisionError), scratch():
        path = path_of(written(spark.range(3)))
        raise ZeroDivisionError
    assert not os.path.exists(path)


def test_dropped_takes_only_the_named_table(spark):
    one, two = written(spark.range(3)), written(spark.range(4))
    path = path_of(one)
    dropped(one)
    assert not os.path.exists(path) and two.count() == 4


def test_writing_leaves_the_setting_alone_and_the_source_usable(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    source = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    first, second = written(source), written(source)  # a freed shuffle is made again
    assert sorted(first.collect()) == sorted(second.collect()) == sorted(source.collect())
    assert spark.conf.get(key) == before
