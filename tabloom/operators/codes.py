"""Multiclass prediction by error-correcting output codes.

Every class has a row of bits, every column of bits is a two-class problem. A row's predicted bits are
decoded to the class whose code differs in the fewest places, so a few wrong columns do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that one long holds without its sign.
WORD = 62


def code_matrix(n_classes: int, columns: int, seed: int = 0) -> list[list[int]]:
    """A row of bits for each class, its columns all different two-class problems.

    Up to five classes can have every possible column (``2 ** (n - 1) - 1`` of them). Else columns are drawn
    from MD5 digests, and of each thirty-two that which leaves the closest two classes farthest apart is taken.
    """
    most = 2 ** (n_classes - 1) - 1
    if n_classes < 2 or columns < 1:
        raise ValueError("a code needs two classes and a column")
    if columns > most:
        raise ValueError(f"{n_classes} classes have only {most} different columns")
    if columns == most and n_classes <= 12:
        return [[1] * most if c == 0 else [(v >> (n_classes - 1 - c)) & 1 for v in range(most)] for c in range(n_classes)]
    chosen: list[tuple[int, ...]] = []
    distance, draw = np.zeros((n_classes, n_classes), int), 0
    while len(chosen) < columns:
        best, best_key = None, None
        found = 0
        while found < 32 and (best is None or found < most - len(chosen)):
            digest = b"".join(hashlib.md5(f"{seed}|{draw}|{part}".encode()).digest() for part in range(n_classes // 128 + 1))
            draw += 1
            bits = tuple((digest[c // 8] >> (c % 8)) & 1 for c in range(n_classes))
            bits = bits if bits[0] else tuple(1 - b for b in bits)  # a column and its complement ask the same
            found += 1
            if all(bits) or bits in chosen:
                continue
            apart = distance + (np.array(bits)[:, None] != np.array(bits)[None, :])
            off = apart[~np.eye(n_classes, dtype=bool)]
            key = (off.min(), -int((off == off.min()).sum()), int(off.sum()))
            if best is None or key > best_key:
                best, best_key = bits, key
        chosen.append(best)
        distance += np.array(best)[:, None] != np.array(best)[None, :]
    return [[column[c] for column in chosen] for c in range(n_classes)]


def packed(bits: Sequence[int]) -> list[int]:
    """Bits as whole numbers of ``WORD`` bits, the first bit lowest."""
    return [sum(b << i for i, b in enumerate(bits[at : at + WORD])) for at in range(0, len(bits), WORD)]


def _nearest(bits: Column, codes: Sequence[Sequence[int]]) -> Column:
    """(d, at): fewest differing bits, and the place of the first code that differs in so few."""

    def distance(code: Sequence[int]) -> Column:
        return sum((F.bit_count(F.get(bits, F.lit(i)).bitwiseXOR(F.lit(w).cast("long"))) for i, w in enumerate(packed(code))), F.lit(0))

    return F.array_min(F.array(*(F.struct(distance(code).alias("d"), F.lit(at).alias("at")) for at, code in enumerate(codes))))


def nearest_distance(bits: Column, codes: Sequence[Sequence[int]]) -> Column:
    """Bits in which the packed ``bits`` differ from the nearest code."""
    return _nearest(bits, codes)["d"]


def decode(bits: Column, classes: Sequence, codes: Sequence[Sequence[int]]) -> Column:
    """The class whose code is nearest to the packed ``bits``; of equally near ones the first in ``classes``."""
    return F.get(F.array(*(F.lit(c) for c in classes)), _nearest(bits, codes)["at"])


@dataclass
class CodeModel:
    """Classes in order, their codes, and how the bits of a row are found."""

    classes: list
    codes: list[list[int]]
    models: list[Model] = field(default_factory=list)
    weights: np.ndarray | None = None
    bounds: np.ndarray | None = None
    features: str = "features"

    def bits(self, df: DataFrame) -> DataFrame:
        """Add ``bits``, the predicted bit of every column, packed."""
        if self.weights is not None:
            weights, bounds = self.weights, self.bounds

            @F.pandas_udf("array<long>")
            def sides(vectors: pd.Series) -> pd.Series:
                if not len(vectors):
                    return pd.Series([], dtype=object)
                above = np.stack(vectors.to_numpy()) @ weights.T > bounds
                return pd.Series([packed(row) for row in above.astype(int).tolist()])

            return df.withColumn("bits", sides(self.features))
        names = [f"_bit_{i}" for i in range(len(self.models))]
        out = df
        for name, model in zip(names, self.models, strict=True):
            out = model.transform(out).withColumnRenamed("prediction", name).drop("rawPrediction", "probability")
        word = lambda some: sum((F.shiftleft(F.col(n).cast("long"), i) for i, n in enumerate(some)), F.lit(0).cast("long"))
        return out.withColumn("bits", F.array(*(word(names[at : at + WORD]) for at in range(0, len(names), WORD)))).drop(*names)

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``bits`` and ``prediction``."""
        return self.bits(df).withColumn("prediction", decode(F.col("bits"), self.classes, self.codes))


def _classes(train: DataFrame, label: str) -> list:
    found = sorted(r[0] for r in train.filter(F.col(label).isNotNull()).select(label).distinct().collect())
    if len(found) < 2:
        raise ValueError("a code needs two classes")
    return found


def _codes(classes: list, columns: int | None, codes: list[list[int]] | None, seed: int) -> list[list[int]]:
    if codes is not None:
        return codes
    most = 2 ** (len(classes) - 1) - 1
    return code_matrix(len(classes), min(most, columns or 2 * len(classes) - 1), seed)


def fit_columns(
    train: DataFrame, classifier: Estimator, columns: int | None = None, codes: list[list[int]] | None = None, label: str = "label",
    seed: int = 0, parallelism: int = 4,
) -> CodeModel:
    """One fit of ``classifier`` (two classes, ``featuresCol`` and ``predictionCol`` of its own) for each column.

    ``train`` is read once for each column, so hand over a stored table. Rows without a label take no part.
    """
    classes = _classes(train, label)
    codes = _codes(classes, columns, codes, seed)
    at = F.map_from_arrays(F.array(*(F.lit(c) for c in classes)), F.array(*(F.lit(i) for i in range(len(classes)))))
    known = train.filter(F.col(label).isNotNull()).select(classifier.getFeaturesCol(), at[F.col(label)].alias("_class"))

    def one(column: int) -> Model:
        bit = F.get(F.array(*(F.lit(float(code[column])) for code in codes)), F.col("_class"))
        return classifier.copy({classifier.labelCol: "_bit"}).fit(known.select(classifier.getFeaturesCol(), bit.alias("_bit")))

    with ThreadPool(parallelism) as pool:
        return CodeModel(classes, codes, pool.map(one, range(len(codes[0]))), features=classifier.getFeaturesCol())


def fit_centroids(
    train: DataFrame, columns: int | None = None, codes: list[list[int]] | None = None, label: str = "label", vector: str = "vec", seed: int = 0
) -> CodeModel:
    """Every column decides for the nearer of the means of its two sides.

    The means of all columns come from the sums of the classes, so the rows are read once however many
    columns there are. ``vector`` is an array; rows without a label or vector take no part.
    """
    rows = train.filter(F.col(label).isNotNull() & F.col(vector).isNotNull())
    classes = _classes(rows, label)
    codes = _codes(classes, columns, codes, seed)
    sums = rows.select(label, F.posexplode(vector).alias("at", "v")).groupBy(label, "at").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))
    found = sums.collect()  # classes x dimensions
    dim = 1 + max(r["at"] for r in found)
    total, n = np.zeros((len(classes), dim)), np.zeros(len(classes))
    for r in found:
        total[classes.index(r[label]), r["at"]] = r["v"]
        n[classes.index(r[label])] = max(n[classes.index(r[label])], r["n"])
    bit = np.array(codes).T.astype(bool)
    one = np.stack([total[b].sum(axis=0) / n[b].sum() for b in bit])
    zero = np.stack([total[~b].sum(axis=0) / n[~b].sum() for b in bit])
    bounds = (np.square(one).sum(axis=1) - np.square(zero).sum(axis=1)) / 2
    return CodeModel(classes, codes, weights=one - zero, bounds=bounds, features=vector)
