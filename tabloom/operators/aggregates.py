"""Grouped and global aggregates. All combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.rows import null_count
from tabloom.plans import exact_percentiles, row_number_within, with_position


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def max_by(df: DataFrame, key: str) -> DataFrame:
    """Maximum of every numeric column per group."""
    return df.groupBy(key).agg(*[F.max(c).alias(f"max_{c}") for c in numeric_columns(df) if c != key])


def size_stats(df: DataFrame, column: str) -> DataFrame:
    """Average (also truncated), minimum and maximum of a column."""
    return df.agg(
        F.avg(column).alias("avg_size"),
        F.floor(F.avg(column)).alias("avg_size_int"),
        F.min(column).alias("min_size"),
        F.max(column).alias("max_size"),
    )


def having_count(df: DataFrame, key: str, more_than: int) -> DataFrame:
    """Groups with more than the given number of rows."""
    return count_by(df, key).filter(F.col("n") > more_than)


def distinct_count(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def daily_hosts(logs: DataFrame, host: str = "host", ts: str = "date_time") -> DataFrame:
    """Distinct hosts per day of the month."""
    return logs.groupBy(F.dayofmonth(ts).alias("day")).agg(F.count_distinct(host).alias("hosts"))


def avg_daily_requests(logs: DataFrame, host: str = "host", ts: str = "date_time") -> DataFrame:
    """Requests per host and day, as a fraction and as an integer."""
    days = logs.groupBy(F.dayofmonth(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_distinct(host).alias("hosts")
    )
    return days.select(
        "day", (F.col("requests") / F.col("hosts")).alias("average"), F.expr("requests div hosts").alias("average_int")
    )


def count_by_part(df: DataFrame, part: Column, name: str) -> DataFrame:
    """Rows per date part (day, hour, ...)."""
    return df.groupBy(part.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def tag_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per element of an array column."""
    return count_by(df.select(F.explode(column).alias("tag")), "tag")


def count_where_max(df: DataFrame, key: str, column: str, more_than) -> DataFrame:
    """How many ids reach a maximum above the limit."""
    best = df.groupBy(key).agg(F.max(column).alias("best"))
    return best.agg(F.count_if(F.col("best") > more_than).alias("n"))


def unique_per_group(df: DataFrame, group: str, key: str) -> DataFrame:
    """Distinct keys per group."""
    return count_by(df.select(group, key).distinct(), group)


def word_count(lines: DataFrame, column: str) -> DataFrame:
    """Occurrences of each word, words being split at blanks."""
    return count_by(lines.select(F.explode(F.split(column, " ")).alias("word")), "word")


def top_mass(counts: DataFrame, key: str, k: int, n: str = "n") -> DataFrame:
    """Sum of the k largest counts."""
    return counts.orderBy(F.desc(n), key).limit(k).agg(F.sum(n).alias("total"))


def fold(df: DataFrame, column: str) -> DataFrame:
    """Sum and product-free folds over one column."""
    return df.agg(F.sum(column).alias("total"), F.max(column).alias("largest"), F.min(column).alias("smallest"))


def group_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values of each key with their counts, and the key's sum.

    The list of all values per key is kept as (value, count) rows, so a hot key stays spread.
    """
    counted = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    sums = df.groupBy(key).agg(F.sum(value).alias("total"))
    return counted.join(sums, key)


def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Counts of ``row`` by ``col``, absent pairs 0. Known values save a pass."""
    wide = df.groupBy(row).pivot(col, list(values) if values else None).count()
    return wide.fillna(0)


def rate_by(df: DataFrame, group: str, flag: str) -> DataFrame:
    """Counts of flag 0 and 1 per group and the rate of 1."""
    return df.groupBy(group).agg(
        F.count_if(F.col(flag) == 0).alias("no"),
        F.count_if(F.col(flag) == 1).alias("yes"),
        F.avg(F.col(flag).cast("double")).alias("rate"),
    )


def crosstab_norm(df: DataFrame, row: str, col: str) -> DataFrame:
    """Share of each ``row`` value within its ``col`` value, in long form."""
    cells = count_by(df, row, col)
    totals = cells.groupBy(col).agg(F.sum("n").alias("total"))
    return cells.join(totals, col).select(row, col, (F.col("n") / F.col("total")).alias("share"))


def pivot_mean(df: DataFrame, row: str, col: str, value: str, values: Sequence) -> DataFrame:
    """Long to wide by the mean; the column values are given, so no pass looks for them."""
    return df.groupBy(row).pivot(col, list(values)).agg(F.avg(value))


def item_stats(ratings: DataFrame, key: str = "item_id") -> DataFrame:
    """Mean rating and number of ratings per item (or per user)."""
    return ratings.groupBy(key).agg(F.avg("rating").alias("mean_rating"), F.count(F.lit(1)).alias("n"))


def density(ratings: DataFrame) -> DataFrame:
    """Interactions per user and per item, and the empty share of the matrix in percent."""
    sizes = ratings.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.count_distinct("item_id").alias("items")
    )
    return sizes.select(
        "n", "users", "items",
        (F.col("n") / F.col("users")).alias("per_user"),
        (F.col("n") / F.col("items")).alias("per_item"),
        ((1 - F.col("n") / (F.col("users").cast("double") * F.col("items"))) * 100).alias("sparsity"),
    )


def longtail(ratings: DataFrame) -> DataFrame:
    """Mean popularity of the top, bottom and middle tenth of the items.

    Items are placed by count in a distributed sort; no window holds them all.
    """
    counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    placed = with_position(counts, [F.desc("n"), F.col("item_id")], "place")
    total = placed.count()
    tenth, low, high = int(total / 10), int(total * 0.45), int(total * 0.55)
    place = F.col("place")
    part = (
        F.when(place <= tenth, "top")
        .when(place > total - tenth, "bottom")
        .when((place > low) & (place <= high), "middle")
    )
    return placed.withColumn("part", part).filter("part IS NOT NULL").groupBy("part").agg(F.avg("n").alias("mean_n"))


def segment_users(ratings: DataFrame) -> DataFrame:
    """(user_id, n, segment): ``frequent`` at or over the mean number of ratings, else ``new``."""
    counts = count_by(ratings, "user_id")
    mean = counts.agg(F.avg("n")).scalar()
    return counts.withColumn("segment", F.when(F.col("n") >= mean, "frequent").otherwise("new"))


def freq_encode(df: DataFrame, column: str) -> DataFrame:
    """(value, freq): relative frequency of each value, to join back by value."""
    counts = count_by(df, column)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, (F.col("n") / total).alias("freq"))


def null_profile(df: DataFrame, by: str | None = None) -> DataFrame:
    """(column, nulls, percent), also per group: one pass over the data."""
    names = [c for c in df.columns if c != by]
    keys = [by] if by else []
    wide = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names]
    )
    long = wide.unpivot([*keys, "_rows"], names, "column", "nulls")
    return long.select(*keys, "column", "nulls", (F.col("nulls") * 100 / F.col("_rows")).alias("percent"))


def nulls_per_row(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Mean and maximum number of nulls in a row, per class."""
    counted = df.withColumn("_nulls", null_count(columns))
    return counted.groupBy(by).agg(F.avg("_nulls").alias("mean_nulls"), F.max("_nulls").alias("max_nulls"))


def null_cooccurrence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n, percent): rows with a null in the column and at least n nulls in all."""
    counted = df.withColumn("_nulls", null_count(columns))
    cells = [(c, n) for c in columns for n in range(1, len(columns) + 1)]
    wide = counted.agg(
        *[
            (F.avg((F.col(c).isNull() & (F.col("_nulls") >= n)).cast("double")) * 100).alias(f"{c}|{n}")
            for c, n in cells
        ]
    )
    long = wide.unpivot([], [f"`{c}|{n}`" for c, n in cells], "cell", "percent")
    parts = F.split("cell", r"\|")
    return long.select(parts[0].alias("column"), parts[1].cast("int").alias("n"), "percent")


def histogram(df: DataFrame, column: str, bins: int, low: float, high: float, by: str | None = None) -> DataFrame:
    """(bin, n) over equal bins of ``[low, high]``; the last bin holds its upper edge."""
    keys = [by] if by else []
    width = (high - low) / bins
    at = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
    inside = df.filter((F.col(column) >= low) & (F.col(column) <= high))
    return inside.groupBy(*keys, at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def mean_median(df: DataFrame, column: str) -> DataFrame:
    """Mean and exact median; the median comes from a distributed sort of distinct values."""
    median = exact_percentiles(df, column, [0.5])[0]
    return df.agg(F.avg(column).alias("mean"), F.lit(median).alias("median"))


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column replaced by its rank; equal values share the mean of their ranks.

    Values are counted, the distinct ones ranked by a distributed sort, and the ranks joined
    back by value, so no column is sorted whole in one place.
    """
    for c in columns:
        placed = with_position(count_by(df, c, name="_n"), [c], "_pos", {"_upto": F.col("_n")})
        ranks = placed.select(c, (F.col("_upto") - (F.col("_n") - 1) / 2).alias("_rank"))
        df = df.join(ranks, c).drop(c).withColumnRenamed("_rank", c)
    return df


def corr_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """(a, b, corr) for all pairs of columns, the matrix in long form."""
    rows = df.select(*columns).dropna()
    if method == "spearman":
        rows = average_ranks(rows, columns)
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_vec").transform(rows)
    matrix = Correlation.corr(vectors, "_vec").first()[0].toArray()
    cells = [(a, b, float(matrix[i][j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(cells, "a string, b string, corr double")


def corr_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The Pearson matrix as one aggregate over built-in ``corr``."""
    cells = [(a, b) for a in columns for b in columns]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in cells])
    parts = F.split("cell", r"\|")
    return wide.unpivot([], [f"`{a}|{b}`" for a, b in cells], "cell", "corr").select(
        parts[0].alias("a"), parts[1].alias("b"), "corr"
    )


def summarize(df: DataFrame, vector: str, weight: str | None = None) -> DataFrame:
    """Mean vector and count, weighted or not."""
    metrics = Summarizer.metrics("mean", "count")
    summary = metrics.summary(F.col(vector), F.col(weight)) if weight else metrics.summary(F.col(vector))
    return df.select(summary.alias("s")).select(F.col("s.mean").alias("mean"), F.col("s.count").alias("count"))


def acf(series: DataFrame, max_lag: int, key: str = "series", order: Sequence[str] = ("t", "id"), value: str = "value") -> DataFrame:
    """(series, lag, acf): autocorrelation with the overall mean and the biased denominator.

    Places within the series come from a distributed sort; lagged products meet by an
    equi-join on (series, place), so a long series is spread over all tasks.
    """
    placed = row_number_within(series.select(key, *order, value), [key], list(order), "_at")
    means = placed.groupBy(key).agg(F.avg(value).alias("_mean"))
    centred = placed.join(means, key).select(key, "_at", (F.col(value) - F.col("_mean")).alias("_x"))
    ahead = centred.select(key, F.col("_x").alias("_y"), F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"), F.col("_at"))
    pairs = ahead.withColumn("_at", F.col("_at") + F.col("lag")).join(centred, [key, "_at"])
    products = pairs.groupBy(key, "lag").agg(F.sum(F.col("_x") * F.col("_y")).alias("_s"))
    variance = products.filter("lag = 0").select(key, F.col("_s").alias("_s0"))
    return products.join(variance, key).select(key, "lag", (F.col("_s") / F.col("_s0")).alias("acf"))


def series_error(df: DataFrame, actual: str, forecast: str, key: str) -> DataFrame:
    """Mean squared error of a forecast and the sample deviation of the series."""
    return df.groupBy(key).agg(
        F.avg(F.pow(F.col(actual) - F.col(forecast), 2)).alias("mse"), F.stddev_samp(actual).alias("sd")
    )
