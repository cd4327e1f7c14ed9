"""Error-correcting codes: the matrix, decoding against brute force, and fits of both kinds."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloom.operators import codes


@pytest.mark.parametrize("n, columns", [(2, 1), (3, 3), (5, 15), (10, 15), (10, 19), (40, 130)])
def test_matrix(n, columns):
    matrix = np.array(codes.code_matrix(n, columns))
    assert matrix.shape == (n, columns) and set(matrix.ravel()) <= {0, 1}
    turned = {tuple(c) if c[0] else tuple(1 - c) for c in matrix.T}
    assert len(turned) == columns and all(0 < sum(c) < n for c in matrix.T)
    least = min((matrix[a] != matrix[b]).sum() for a in range(n) for b in range(a))
    assert least >= (1 if columns < 15 else columns // 4)
    assert codes.code_matrix(n, columns) == matrix.tolist()
    with pytest.raises(ValueError):
        codes.code_matrix(3, 4)


@pytest.mark.parametrize("columns", [15, 62, 63, 130])
def test_decode(spark, columns):
    rng = random.Random(columns)
    matrix, names = codes.code_matrix(12, columns), [f"c{i:02d}" for i in range(12)]
    rows = [[rng.randrange(2) for _ in range(columns)] for _ in range(60)] + matrix
    df = spark.createDataFrame([(i, codes.packed(r)) for i, r in enumerate(rows)], "id long, bits array<long>")
    got = df.select("id", codes.decode(F.col("bits"), names, matrix).alias("c"), codes.nearest_distance(F.col("bits"), matrix).alias("d")).collect()
    for r in got:
        far = [sum(a != b for a, b in zip(rows[r.id], code, strict=True)) for code in matrix]
        assert (r.d, r.c) == (min(far), names[far.index(min(far))])


def test_wrong_bits_are_corrected():
    matrix = np.array(codes.code_matrix(10, 31))
    least = min((matrix[a] != matrix[b]).sum() for a in range(10) for b in range(a))
    rng = np.random.default_rng(0)
    for c in range(10):
        flipped = matrix[c].copy()
        flipped[rng.choice(31, (least - 1) // 2, replace=False)] ^= 1
        assert ((matrix != flipped).sum(axis=1)).argmin() == c


def test_fits(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 5)) * 6
    rows = [(i, (centres[i % 6] + rng.standard_normal(5)).tolist(), "abcdef"[i % 6]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label string").withColumn("features", array_to_vector("vec"))
    odd = df.unionByName(spark.createDataFrame([(900, None, "a")], "id long, vec array<double>, label string"), allowMissingColumns=True)
    means = codes.fit_centroids(odd.unionByName(df.limit(1).withColumn("label", F.lit(None).cast("string"))))
    fits = codes.fit_columns(df, LogisticRegression(maxIter=20), columns=9)
    assert means.classes == fits.classes == list("abcdef") and len(fits.models) == 9
    for model in (means, fits):
        assert model.predict(df).filter("prediction = label").count() >= 295
    with pytest.raises(ValueError):
        codes.fit_centroids(df.filter("label = 'a'"))
