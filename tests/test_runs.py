"""Numbers and sums within keys against windows: hot, single, null and many keys, in small batches."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabloom.plans import numbered

KEYS = {
    "hot": "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 7 < 5 THEN 'hot' ELSE cast(id % 50 AS string) END",
    "one": "'one'", "each": "cast(id AS string)", "nan": "CASE WHEN id % 2 = 0 THEN double('NaN') ELSE id % 3 END",
}


@pytest.mark.parametrize("kind", sorted(KEYS))
def test_numbered(spark, kind):
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.range(2000).selectExpr(f"{KEYS[kind]} AS k", "id % 4 AS j", "hash(id) AS v", "id", "id AS _n", "'x' AS _task")
        for keys in (["k"], ["k", "j"]):
            window = Window.partitionBy(*keys).orderBy(F.desc("v"), "id")
            total = F.sum(F.col("v").cast("long")).over(window.rowsBetween(Window.unboundedPreceding, 0))
            want = df.withColumn("n", F.row_number().over(window).cast("long")).withColumn("s", total)
            got = numbered(df, keys, [F.desc("v"), "id"], "n", {"s": F.col("v").cast("long")})
            assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert numbered(df.limit(0), ["k"], ["id"]).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
