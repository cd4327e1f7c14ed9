"""Common log format, as column expressions (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: host, identd, user, time, method, endpoint, protocol, status, size.
# (?U) gives \S and \w their Unicode meaning. The strict form allows no blank before the quote.
_HEAD = r'(?U)^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)'
STRICT = _HEAD + r'" (\d{3}) (\S+)'
FIXED = _HEAD + r'\s?" (\d{3}) (\S+)'


def parse_clf_time(time: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss`` as a zone-free timestamp; the offset is ignored."""
    return F.to_timestamp_ntz(F.substring(time, 1, 20), F.lit("dd/MMM/yyyy:HH:mm:ss"))


def clf_size(size: Column) -> Column:
    """Size in bytes; ``-`` means 0."""
    return F.when(size == "-", F.lit(0).cast("long")).otherwise(size.try_cast("long"))


# Groups in the order they are written out for splitting. No group but the time can hold a line
# break, so the time comes last.
_ORDER = (1, 2, 3, 5, 6, 7, 8, 9, 4)


def parse_clf(lines: DataFrame, line: str = "line", fixed: bool = True) -> DataFrame:
    """Add the nine fields and ``parsed``; fields are null on a line that does not match.

    The pattern runs twice per line, once for the flag and once to cut out all groups.
    """
    pattern = FIXED if fixed else STRICT
    cut = F.regexp_replace(F.col(line), pattern, "\n".join(f"${i}" for i in _ORDER) + "\n")
    staged = lines.withColumn("parsed", F.col(line).rlike(pattern)).withColumn(
        "_fields", F.when(F.col("parsed"), F.split(cut, "\n"))
    )

    def group(i: int) -> Column:
        return F.col("_fields")[_ORDER.index(i)]

    return staged.select(
        *lines.columns,
        "parsed",
        group(1).alias("host"),
        group(2).alias("client_identd"),
        group(3).alias("user_id"),
        parse_clf_time(group(4)).alias("date_time"),
        group(5).alias("method"),
        group(6).alias("endpoint"),
        group(7).alias("protocol"),
        group(8).try_cast("int").alias("response_code"),
        clf_size(group(9)).alias("content_size"),
    )


def parse_report(parsed: DataFrame) -> DataFrame:
    """Read, parsed and failed line counts in one pass."""
    return parsed.agg(
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(F.col("parsed")).alias("lines_parsed"),
        F.count_if(~F.col("parsed")).alias("lines_failed"),
    )
