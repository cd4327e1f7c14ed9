"""Windows, sorts, top-k, samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.plans import row_number_within, with_position


def best_per_id(posts: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """Largest value of each (group, key)."""
    return posts.groupBy(group, key).agg(F.max(value).alias(value))


def topn_rank(df: DataFrame, group: str, value: str, n: int = 3) -> DataFrame:
    """Rows with rank at most n per group; ties share a rank. Spark limits groups before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc(value))
    return df.withColumn("rank", F.rank().over(order)).filter(F.col("rank") <= n)


def topn_rownum(df: DataFrame, group: str, value: str, key: str, n: int = 3, key_desc: bool = False) -> DataFrame:
    """Exactly n rows per group; ties go by the key."""
    order = Window.partitionBy(group).orderBy(F.desc(value), F.desc(key) if key_desc else F.asc(key))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def topn_list(df: DataFrame, group: str, value: str, key: str, n: int = 3) -> DataFrame:
    """Per group the n largest (value, key) pairs as a list; ties go to the larger key."""
    top = topn_rownum(df, group, value, key, n, key_desc=True)
    pairs = F.array_sort(F.collect_list(F.struct("rank", key, value)))
    return top.groupBy(group).agg(pairs.alias("top"))


def last_n(
    ratings: DataFrame,
    n: int = 3,
    user: str = "user_id",
    item: str = "item_id",
    ts: str = "ts",
    hot_rows: int | None = None,
    run_rows: int = 262_144,
    more: Sequence[str] = (),
) -> DataFrame:
    """Add ``last_1 .. last_n``: the items of the same user just before each event, else 0.

    Each column of ``more`` gives ``<column>_1 .. <column>_n`` in line with them, null where there is no event.
    The rows are sorted over all tasks and cut into runs; each run borrows the n rows before it, so that
    no task ever holds a whole hot user. ``hot_rows`` is accepted from earlier callers and chooses nothing.
    """
    run_rows = max(run_rows, n)
    placed = with_position(ratings, [F.col(user), F.col(ts), F.col(item)], "_pos")
    run = F.floor((F.col("_pos") - 1) / run_rows)
    ends_run = (F.col("_pos") - 1) % run_rows >= run_rows - n
    own = placed.withColumn("_run", run).withColumn("_own", F.lit(True))
    lent = placed.filter(ends_run).withColumn("_run", run + 1).withColumn("_own", F.lit(False))
    window = Window.partitionBy("_run", user).orderBy("_pos")
    lagged = [F.coalesce(F.lag(item, i).over(window), F.lit(0)).alias(f"last_{i}") for i in range(1, n + 1)]
    lagged += [F.lag(c, i).over(window).alias(f"{c}_{i}") for c in more for i in range(1, n + 1)]
    both = own.unionByName(lent).select("*", *lagged)
    return both.filter("_own").drop("_own", "_run", "_pos")


def days_since_start(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``ts_day``: whole days (rounded) since the first event of the table."""
    first = df.agg(F.min(F.unix_timestamp(ts))).scalar()
    return df.withColumn("ts_day", F.round((F.unix_timestamp(ts) - first) / 86400))


def _all_partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions. Given to ``repartition`` it keeps them apart where adaptive
    execution would join them by their packed size, while unfolded rows and the sums of their keys take far more."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def norm_rating(ratings: DataFrame, genres: str = "genre") -> DataFrame:
    """(user_id, item_id, norm_rating): ratings scaled to 0-5 within each (user, genre), then
    averaged over the genres of the item. A flat genre gives 0. ``genres`` is an array column.

    Rows move by user, with their genres still in one array, and each user's bounds come back as a map: the rows
    per genre are never shuffled.
    """
    rows = ratings.select("user_id", "item_id", "rating", F.col(genres).alias("_genres"))
    rows = rows.repartition(_all_partitions(ratings), "user_id")
    long = rows.select("user_id", "rating", F.explode("_genres").alias("_genre")).filter("_genre IS NOT NULL")
    bounds = long.groupBy("user_id", "_genre").agg(F.min("rating").alias("low"), F.max("rating").alias("high"))
    bounds = bounds.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("_genre", F.struct("low", "high")))).alias("_bounds"))

    def scaled(of: Column) -> Column:
        apart = (F.col("rating") - of["low"]) / F.nullif(of["high"] - of["low"], F.lit(0)) * 5
        return F.when(of["high"] == of["low"], F.lit(0.0)).otherwise(apart)

    known = rows.withColumn("_genres", F.filter("_genres", lambda g: g.isNotNull())).filter(F.size("_genres") > 0)
    found = F.transform("_genres", lambda g: F.col("_bounds")[g])
    values = F.filter(F.transform(found, scaled), lambda v: v.isNotNull())
    per_row = known.join(bounds, "user_id").select(
        "user_id", "item_id", F.aggregate(values, F.lit(0.0), lambda t, v: t + v).alias("_sum"), F.size(values).alias("_n")
    )
    total, n = F.sum("_sum"), F.sum("_n")
    return per_row.groupBy("user_id", "item_id").agg((total / F.nullif(n, F.lit(0))).alias("norm_rating"))


def loved_flag(ratings: DataFrame, genres: str = "genre") -> DataFrame:
    """Add the user's threshold and ``loved = rating > threshold``.

    The threshold is the mean, over the user's rated (item, genre) rows, of that genre's mean. Rows move
    by user first, so a task adds up its own users only, and not some rows of every user.
    """
    rows = ratings.select("user_id", "rating", F.col(genres).alias("_genres"))
    rows = rows.repartition(_all_partitions(ratings), "user_id")
    long = rows.select("user_id", "rating", F.explode("_genres").alias("_genre"))
    means = long.groupBy("user_id", "_genre").agg(F.avg("rating").alias("_mean"), F.count(F.lit(1)).alias("_n"))
    limits = means.groupBy("user_id").agg((F.sum(F.col("_mean") * F.col("_n")) / F.sum("_n")).alias("user_threshold"))
    return ratings.join(limits, "user_id").withColumn(
        "loved", (F.col("rating") > F.col("user_threshold")).cast("int")
    )


def topk(df: DataFrame, by: str, key: str, k: int, ascending: bool = False) -> DataFrame:
    """The k largest (or smallest) rows; ties go by the key."""
    return df.orderBy(F.asc(by) if ascending else F.desc(by), key).limit(k)


def top_errors(logs: DataFrame, key: str, k: int, bad: Column) -> DataFrame:
    """Most frequent keys among the log lines that meet the condition."""
    counts = logs.filter(bad).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return topk(counts, "n", key, k)


def sample(df: DataFrame, fraction: float, replace: bool = False, seed: int = 1) -> DataFrame:
    return df.sample(withReplacement=replace, fraction=fraction, seed=seed)


def sample_exact(df: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """Exactly n random rows: a top-n over random keys, or a distributed sort when n is large."""
    keyed = df.withColumn("_r", F.rand(seed))
    if n <= 100_000:
        return keyed.orderBy("_r").limit(n).drop("_r")
    return with_position(keyed, ["_r"], "_pos").filter(F.col("_pos") <= n).drop("_r", "_pos")


def hash_number(keys: Sequence[str], seed: int = 0) -> Column:
    """A number in [0, 2^32) from the MD5 of the seed and the keys; any SQL engine can restate it."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_unit(keys: Sequence[str], seed: int = 0) -> Column:
    """A number in [0, 1) that depends only on the keys and the seed."""
    return hash_number(keys, seed) / float(1 << 32)


def split(df: DataFrame, weights: Sequence[float], keys: Sequence[str], seed: int = 0) -> list[DataFrame]:
    """Reproducible random split by a hash of the keys: the same row always lands alike."""
    at, total, parts = hash_unit(keys, seed), float(sum(weights)), []
    low = 0.0
    for i, w in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + w / total
        parts.append(df.filter((at >= low) & (at < high)))
        low = high
    return parts


def md5_order(keys: Sequence[str], seed: int = 0) -> Column:
    """A pseudo-random sort key that any SQL engine can restate."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def split_per_user(
    ratings: DataFrame, test_share: float = 0.2, user: str = "user_id", item: str = "item_id", seed: int = 0,
    round_up: bool = True, hot_rows: int | None = None,
) -> DataFrame:
    """Add ``for_testing``: a random share of each user's rows, rounded up (or down) to whole rows."""
    keyed = ratings.withColumn("_h", md5_order([user, item], seed))
    ranked = row_number_within(keyed, [user], ["_h", item], "_rn", hot_rows)
    sizes = ranked.groupBy(user).agg(F.max("_rn").alias("_n"))  # from the stored ranks, not the input again
    wanted = F.ceil(F.col("_n") * test_share) if round_up else F.floor(F.col("_n") * test_share)
    return (
        ranked.join(sizes, user).withColumn("for_testing", F.col("_rn") <= wanted).drop("_h", "_rn", "_n")
    )


def split_items(ratings: DataFrame, train_share: float = 0.75, seed: int = 0) -> DataFrame:
    """Add ``for_training``: ``int(share * n)`` of each user's rated items."""
    out = split_per_user(ratings, train_share, seed=seed, round_up=False)
    return out.withColumnRenamed("for_testing", "for_training")


def kfold(df: DataFrame, k: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Add ``fold`` in 0 .. k-1 by a hash of the keys; no shuffle."""
    return df.withColumn("fold", (hash_number(keys, seed) % k).cast("int"))


# --- set operations -----------------------------------------------------------------------


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def vocabulary(lists: DataFrame, column: str) -> DataFrame:
    """Set union of item lists."""
    return lists.select(F.explode(column).alias("item")).distinct()


def intersect_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)
