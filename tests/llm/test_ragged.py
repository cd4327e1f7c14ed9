"""Vectors of other lengths take no part in a search, and take no others out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import neighbours


@pytest.mark.parametrize("odd_first", [True, False])
def test_ragged_vectors(spark, odd_first):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(40)]
    ragged = [(100 + i, rng.standard_normal(2).tolist()) for i in range(30)] if odd_first else [(100, [1.0, 2.0])]
    df = spark.createDataFrame(rows + ragged + [(200, None), (201, []), (202, [0.0] * 3)], "vec_id long, embedding array<double>")
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, k=20).collect()
    assert len(got) == 40 and {r.query_id for r in got} == {0, 20}
    for q in (0, 20):
        want = sorted((-float(np.dot(rows[q][1], v)), i) for i, v in rows if i != q)[:20]
        assert [i for _, i in want] == [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
    only = spark.createDataFrame([(200, None), (202, [0.0] * 3)], "vec_id long, embedding array<double>")
    assert neighbours.search(only, F.lit(True)).count() == 0
