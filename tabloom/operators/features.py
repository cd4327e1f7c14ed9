"""Feature engineering and scaling.

Fits return a few numbers per column, so a transform learnt on one table can be applied to
another. Anything whose size follows the data (vocabularies, codes) stays a table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import HashingTF, OneHotEncoder, PolynomialExpansion, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import text
from tabloom.operators.aggregates import count_by
from tabloom.plans import exact_percentiles, nearest_neighbours, spread, with_position, written

Scaling = Mapping[str, tuple[float, float]]  # column -> (shift, width)

#: Words of a chunk of vectors at most, and documents of a block for each chunk.
MOST_WORDS, CELL_DOCS = 131_072, 8_192


# --- scaling ------------------------------------------------------------------------------


def fit_standard(df: DataFrame, columns: Sequence[str], ddof: int = 0) -> Scaling:
    """Mean and deviation: population (``ddof=0``) or sample (``ddof=1``)."""
    deviation = F.stddev_samp if ddof else F.stddev_pop
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[deviation(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Minimum and range; fit on the training rows only."""
    row = df.agg(
        *[F.min(c).alias(f"a_{c}") for c in columns], *[F.max(c).alias(f"b_{c}") for c in columns]
    ).first()
    return {c: (float(row[f"a_{c}"]), float(row[f"b_{c}"]) - float(row[f"a_{c}"])) for c in columns}


def fit_percentile(df: DataFrame, columns: Sequence[str], theta: float = 1.0) -> Scaling:
    """Exact percentiles theta and 100 - theta; values beyond them are not clipped."""
    out = {}
    for c in columns:
        low, high = exact_percentiles(df, c, [theta / 100, 1 - theta / 100])
        out[c] = (low, high - low)
    return out


def apply_scaling(df: DataFrame, scaling: Scaling) -> DataFrame:
    """``(x - shift) / width`` for each fitted column; a zero width gives 0."""
    return df.withColumns(
        {c: ((F.col(c) - shift) / width if width else F.lit(0.0)) for c, (shift, width) in scaling.items()}
    )


# --- categories ---------------------------------------------------------------------------


def category_codes(df: DataFrame, column: str, by: str = "frequency") -> DataFrame:
    """(column, code from 0): by falling frequency (ties by value) or in sorted order."""
    counts = count_by(df.filter(F.col(column).isNotNull()), column)
    order = [F.desc("n"), F.col(column)] if by == "frequency" else [F.col(column)]
    placed = with_position(counts, order, "_pos")
    return placed.select(column, (F.col("_pos") - 1).alias("code"))


def index_strings(df: DataFrame, column: str, by: str = "frequency", name: str | None = None) -> DataFrame:
    """Add the code of each value."""
    codes = category_codes(df, column, by).withColumnRenamed("code", name or f"{column}_index")
    return df.join(codes, column, "left")


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Indexed columns to one-hot vectors ``{col}_vec`` with every level kept."""
    encoder = OneHotEncoder(inputCols=list(columns), outputCols=[f"{c}_vec" for c in columns], dropLast=False)
    return encoder.fit(df).transform(df)


def dummies(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """One 0/1 column ``{column}_{value}`` per given value."""
    return df.withColumns({f"{column}_{v}": F.col(column).eqNullSafe(F.lit(v)).cast("int") for v in values})


def encode_lists(df: DataFrame, key: str, column: str, n: int = 15, size: int = 3, sep: str = "|") -> DataFrame:
    """(key, code_1 .. code_size): values of a multi-value text as frequency codes from 1.

    Codes of n and above are dropped, the last ``size`` are kept, zeros follow.
    """
    values = df.select(key, F.posexplode(F.split(F.lower(column), f"[{sep}]")).alias("_at", "_value"))
    codes = category_codes(values, "_value").filter(F.col("code") + 1 < n)
    coded = values.join(codes, "_value").groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("_at", "code"))).alias("_c")
    )
    kept = F.slice("_c", F.greatest(F.size("_c") - (size - 1), F.lit(1)), size)
    out = df.select(key).join(coded.select(key, F.transform(kept, lambda c: c["code"] + 1).alias("_k")), key, "left")
    return out.select(
        key, *[F.coalesce(F.get("_k", F.lit(i)), F.lit(0).cast("long")).alias(f"code_{i + 1}") for i in range(size)]
    )


# --- vectors ------------------------------------------------------------------------------


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def poly_expand(df: DataFrame, column: str, degree: int = 2, name: str = "poly") -> DataFrame:
    return PolynomialExpansion(degree=degree, inputCol=column, outputCol=name).transform(df)


def hashing_tf(df: DataFrame, tokens: str, size: int = 1 << 12, name: str = "features") -> DataFrame:
    return HashingTF(numFeatures=size, inputCol=tokens, outputCol=name).transform(df)


# --- text features --------------------------------------------------------------------------


def bag_of_words(docs: DataFrame, key: str, column: str) -> DataFrame:
    """(key, term, n): lower-case words without stop words, counted per document."""
    terms = spread(docs.select(key, column)).select(key, F.explode(text.words(F.col(column))).alias("term"))
    return count_by(terms.filter(~F.col("term").isin(text.STOP_WORDS)), key, "term")


def _document_frequency(arrays: DataFrame, column: str, least: float) -> DataFrame:
    """(term, _df) of the terms that occur in at least ``least`` documents.

    explode_outer: the filter that a plain explode adds would be pushed down and compute the
    arrays twice.
    """
    seen = arrays.select(F.explode_outer(F.array_distinct(column)).alias("term"))
    return seen.groupBy("term").agg(F.count(F.lit(1)).alias("_df")).filter(
        (F.col("_df") >= least) & F.col("term").isNotNull()
    )


def tfidf(
    docs: DataFrame, key: str, column: str, ngram: tuple[int, int] = (1, 3), min_df: float = 0.05, most_words: int = 20_000
) -> DataFrame:
    """(key, term, weight): tf times ``ln((1 + docs) / (1 + df)) + 1``, rows of length 1.

    A run of words is no more frequent than its rarest word, so the frequent single words are
    found first and runs that hold any other word are never built. There are at most (words per
    document) / min_df frequent words; a longer list than ``most_words`` is not used, which
    changes the cost and not the result. Document frequencies of the runs come next, and only
    the terms kept are counted per document.
    """
    tokens = text.remove_stopwords(text.words(F.col(column)))
    words = spread(docs.select(key, column)).select(key, tokens.alias("_t"))
    n_docs = docs.count()
    least = min_df * n_docs
    frequent = [r["term"] for r in _document_frequency(words, "_t", least).limit(most_words + 1).select("term").collect()]
    if len(frequent) <= most_words:
        words = words.select(key, F.transform("_t", lambda w: F.when(w.isin(frequent), w)).alias("_t"))
    grams = words.select(key, text.ngrams(F.col("_t"), *ngram).alias("_g"))
    vocabulary = written(_document_frequency(grams, "_g", least), "vocabulary")
    idf = F.log((1 + F.lit(n_docs)) / (1 + F.col("_df"))) + 1
    kept = grams.select(key, F.explode_outer("_g").alias("term")).join(vocabulary, "term")
    raw = kept.groupBy(key, "term").agg((F.count(F.lit(1)) * F.first(idf)).alias("_w"))
    raw = written(raw, "term-weights")
    norms = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    return raw.join(norms, key).select(key, "term", (F.col("_w") / F.col("_norm")).alias("weight"))


def _block_sums(key: str):
    def cell(block: tuple, known: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if known.empty:
            return pd.DataFrame({key: known[key], "sums": pd.Series([], dtype=object), "n": pd.Series([], dtype=float)})
        vectors = vectors.sort_values("id")
        rows = np.stack(vectors["vec"].to_numpy())
        # A frame in order would hold all columns of the cell twice.
        order = np.argsort(known[key].to_numpy(), kind="stable")
        keys, weight, at = (known[c].to_numpy()[order] for c in (key, "n", "at"))
        weight, at = weight.astype(float), np.searchsorted(vectors["id"].to_numpy(), at)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(starts[1:], len(keys))
        sums = [weight[i:j] @ rows[at[i:j]] for i, j in zip(starts, ends, strict=True)]
        return pd.DataFrame({key: keys[starts], "sums": pd.Series(sums, dtype=object), "n": np.add.reduceat(weight, starts)})

    return cell


def _counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, word, n) of each row (key, words), counted within the row."""
    for part in parts:
        words = pa.table({"at": pc.list_parent_indices(part.column(1)), "word": pc.list_flatten(part.column(1))})
        counts = words.group_by(["at", "word"]).aggregate([([], "count_all")]).combine_chunks()
        for some in counts.to_batches(max_chunksize=100_000):
            columns = [part.column(0).take(some.column("at")), some.column("word"), some.column("count_all")]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "word", "n"])


def _blocking(n_words: int, n_docs: int, chunk_words: int | None, most_docs: int | None) -> tuple[int, int]:
    """Chunks of vectors and blocks of documents. A sum moves for a document and chunk, a vector for a block; with as many
    documents in a block as chunks allow at bounded counts in a task, both come to the same at the root of their ratio."""
    n_chunks = math.ceil(n_words / chunk_words) if chunk_words else max(math.ceil(n_words / MOST_WORDS), math.ceil(math.sqrt(n_words / CELL_DOCS)))
    n_chunks = max(1, n_chunks)
    return n_chunks, max(1, math.ceil(n_docs / (most_docs or CELL_DOCS * n_chunks)))


def sentence_vectors(
    docs: DataFrame, key: str, column: str, vectors: DataFrame, size: int, chunk_words: int | None = None, most_docs: int | None = None
) -> DataFrame:
    """(key, vec): mean of the vectors of the words the table knows, zeros when it knows none.

    ``vectors`` is ``(word, vec array<double>)``. Words are counted within each row first, before anything moves, and
    become numbers by a join. A task then meets a block of documents with a chunk of vectors and emits one sum per
    document, so a vector moves once for each block of documents and not for each word of each document.
    """
    words = spread(docs.select(key, column)).filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.split(column, r"\s+").alias("words"))
    kind = docs.schema[key].dataType.simpleString()
    counts = words.mapInArrow(_counted, f"key {kind}, word string, n long")
    named = vectors.filter(F.col("word").isNotNull() & F.col("vec").isNotNull()).withColumn("id", F.monotonically_increasing_id())
    named = written(named, "word-vectors")
    n_chunks, n_parts = _blocking(named.count(), docs.count(), chunk_words, most_docs)
    chunk = lambda c: F.pmod(F.xxhash64(c), F.lit(n_chunks)).cast("int").alias("chunk")
    known = counts.join(named.select("word", F.col("id").alias("at")), "word")
    known = known.select(F.col("key").alias(key), "at", F.col("n").cast("int").alias("n"), chunk("at"), F.pmod(F.xxhash64("key", F.lit(3)), F.lit(n_parts)).cast("int").alias("part"))
    each = named.select("id", "vec", chunk("id"), F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"))
    sums = known.groupBy("chunk", "part").cogroup(each.groupBy("chunk", "part")).applyInPandas(
        _block_sums(key), f"`{key}` {kind}, sums array<double>, n double"
    )
    zeros = F.array_repeat(F.lit(0.0), size)
    # A document has one row for each chunk at most.
    rows = F.collect_list("sums")
    total = F.aggregate(rows, F.transform(rows[0], lambda x: F.lit(0.0)), lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    means = sums.groupBy(key).agg(total.alias("_sum"), F.sum("n").alias("_n"))
    means = means.select(key, F.transform("_sum", lambda x: x / F.col("_n")).alias("_mean"))
    return docs.select(key).join(means, key, "left").select(key, F.coalesce("_mean", zeros).alias("vec"))


# --- missing values, noise, balance ---------------------------------------------------------


def fill_mean(df: DataFrame, columns: Sequence[str], missing: float | None = None) -> DataFrame:
    """Nulls (and an optional marker such as 99) become the column mean of the other rows."""
    for c in columns if missing is not None else ():
        df = df.withColumn(c, F.when(F.col(c) != missing, F.col(c)))
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.fillna({c: means[c] for c in columns if means[c] is not None})


def fill_value(df: DataFrame, columns: Sequence[str], value=0) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def add_noise(df: DataFrame, k: int = 3, seed: int = 0) -> DataFrame:
    """Add ``random_1 .. random_k``: uniform, normal, log-normal and Weibull noise in turn."""
    uniform, normal = (lambda s: F.rand(s)), (lambda s: F.randn(s))
    kinds = (
        lambda s: uniform(s) * 2 - 1,
        lambda s: normal(s) - 1,
        lambda s: F.exp(normal(s) - 1),
        lambda s: F.pow(-F.log(1 - uniform(s)), F.lit(1 / 3)),
    )
    return df.withColumns({f"random_{i + 1}": kinds[i % 4](seed + i) for i in range(k)})


def draw_index(column: Column, size: Column | int, seed: int = 0) -> Column:
    """A number in 0 .. size-1 from the MD5 of a key; the same everywhere."""
    digest = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), column.cast("string"))), 1, 8)
    return F.conv(digest, 16, 10).cast("long") % size


def undersample(df: DataFrame, label: str, order: str, seed: int = 0) -> DataFrame:
    """All positives, and as many negatives drawn with replacement.

    Negatives get places 1..n from a distributed sort; draw number i picks one place by hash.
    """
    positives, negatives = df.filter(F.col(label) == 1), df.filter(F.col(label) == 0)
    placed = written(with_position(negatives, [order], "_pos"), "negatives")
    n_pos, n_neg = positives.count(), placed.count()
    draws = df.sparkSession.range(n_pos).select((draw_index(F.col("id"), n_neg, seed) + 1).alias("_pos"))
    return positives.unionByName(placed.join(draws, "_pos").drop("_pos"))


def smote(points: DataFrame, k: int = 5, seed: int = 0) -> DataFrame:
    """``(id, vec, label)`` plus synthetic positives until both classes are equal.

    Each synthetic point lies between a positive and one of its k nearest positives; which
    one, and how far along, follow from hashes of its number. Synthetic ids are negative.
    """
    positives, negatives = points.filter("label = 1"), points.filter("label = 0")
    places = written(with_position(positives.select("id", "vec"), ["id"], "_pos"), "positives")
    n_pos, missing = places.count(), negatives.count() - places.count()
    if n_pos < 2 or missing <= 0:
        return points.select("id", "vec", "label")
    near = nearest_neighbours(places, places, k, skip_self=True)
    sizes = near.groupBy("query").agg(F.count(F.lit(1)).alias("_k"))
    number = F.col("number")
    new = points.sparkSession.range(missing).select(F.col("id").alias("number"), (F.col("id") % n_pos + 1).alias("_pos"))
    new = new.join(places.select("_pos", F.col("id").alias("query"), F.col("vec").alias("_from")), "_pos").join(sizes, "query")
    new = new.withColumn("rank", (draw_index(number, F.col("_k"), seed) + 1).cast("int"))
    new = new.join(near.select("query", "rank", "ref"), ["query", "rank"])
    new = new.join(positives.select(F.col("id").alias("ref"), F.col("vec").alias("_to")), "ref")
    gap = draw_index(number, 1_000_003, seed + 1) / 1_000_003
    made = new.select(
        (-number - 1).alias("id"),
        F.zip_with("_from", "_to", lambda a, b: a + gap * (b - a)).alias("vec"),
        F.lit(1).alias("label"),
    )
    return points.select("id", "vec", F.col("label").cast("int").alias("label")).unionByName(made)


def drop_tomek_links(points: DataFrame) -> DataFrame:
    """Drop both ends of every mutual-nearest pair of opposite class."""
    near = nearest_neighbours(points, points, 1, skip_self=True).select("query", "ref")
    labels = points.select("id", "label")
    back = near.select(F.col("ref").alias("query"), F.col("query").alias("ref"))
    mutual = near.join(back, ["query", "ref"])
    ends = mutual.join(labels.withColumnRenamed("id", "query").withColumnRenamed("label", "_a"), "query").join(
        labels.withColumnRenamed("id", "ref").withColumnRenamed("label", "_b"), "ref"
    )
    links = ends.filter(F.col("_a") != F.col("_b")).select(F.col("query").alias("id"))
    return points.join(links, "id", "left_anti")


def smote_tomek(points: DataFrame, k: int = 5, seed: int = 0) -> DataFrame:
    return drop_tomek_links(written(smote(points, k, seed), "smote"))
