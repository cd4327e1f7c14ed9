"""Projection, filters and row-level edits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.plans import with_position


def flatten_struct(df: DataFrame, struct: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Fields of a struct as ``struct_field`` columns; the struct goes."""
    fields = fields or df.schema[struct].dataType.names
    return df.select("*", *[F.col(f"{struct}.{f}").alias(f"{struct}_{f}") for f in fields]).drop(struct)


def overwrite_when(df: DataFrame, column: str, condition: Column, value) -> DataFrame:
    """Replace ``column`` where the condition holds."""
    return df.withColumn(column, F.when(condition, F.lit(value)).otherwise(F.col(column)))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def null_count(columns: Sequence[str]) -> Column:
    """Number of nulls in a row."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNull().cast("int")
    return total


def drop_sparse_rows(df: DataFrame, max_nulls: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with fewer than ``max_nulls`` nulls."""
    return df.filter(null_count(columns or df.columns) < max_nulls)


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop every column that holds a null; one pass counts them all."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if counts[c] > 0])


def recode(df: DataFrame, column: str, names: Mapping) -> DataFrame:
    """Rename values by a lookup; others stay."""
    return df.replace(dict(names), subset=[column])


def recode_by(df: DataFrame, column: str, lookup: DataFrame, old: str, new: str) -> DataFrame:
    """The same with the lookup as a table of any size."""
    pairs = lookup.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = df.join(pairs, F.col(column) == F.col("_old"), "left")
    return joined.withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def split_location(df: DataFrame, column: str = "location") -> DataFrame:
    """``country,state,city`` into three columns; missing parts are null."""
    parts = F.split(column, ",")
    names = ("country", "state", "city")
    return df.select(
        "*", *[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    ).drop(column)


def drop_zero_coords(df: DataFrame, columns: Sequence[str], limit: float = 1e-3) -> DataFrame:
    """Keep rows whose coordinates are all farther than ``limit`` from zero."""
    for c in columns:
        df = df.filter(F.abs(c) > limit)
    return df


def friday_night(ts: Column) -> Column:
    """Friday (weekday 4 from Monday) after the 21st hour."""
    return (F.weekday(ts) == 4) & (F.hour(ts) > 21)


def dedupe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(keys))


def narrow_types(df: DataFrame) -> DataFrame:
    """Smallest integer type that holds each column's range; doubles become floats if they fit.

    One aggregate finds every range. Bounds are exclusive, so a column that touches a
    type's limit keeps the wider type.
    """
    ints = [f.name for f in df.schema if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))]
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if not ints and not floats:
        return df
    ranges = df.agg(
        *[F.min(c).alias(f"min_{c}") for c in ints + floats],
        *[F.max(c).alias(f"max_{c}") for c in ints + floats],
    ).first()
    target = {}
    for c in ints:
        low, high = ranges[f"min_{c}"], ranges[f"max_{c}"]
        if low is None:
            continue
        for name, bits in (("byte", 8), ("short", 16), ("int", 32), ("long", 64)):
            if -(2 ** (bits - 1)) < low and high < 2 ** (bits - 1) - 1:
                target[c] = name
                break
    for c in floats:
        low, high = ranges[f"min_{c}"], ranges[f"max_{c}"]
        if low is not None and -3.4028235e38 < low and high < 3.4028235e38:
            target[c] = "float"
    return df.select(*[F.col(c).cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns])


def slice_rows(df: DataFrame, order: Sequence[str | Column], start: int, end: int) -> DataFrame:
    """Rows at positions ``start <= p < end`` (from 0) under an explicit, unique order."""
    placed = with_position(df, order, "_pos")
    return placed.filter((F.col("_pos") > start) & (F.col("_pos") <= end)).drop("_pos")


def empty_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def nan_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty strings and nulls become the category ``{col}_nan``."""
    return df.withColumns({c: F.coalesce(empty_to_null(F.col(c)), F.lit(f"{c}_nan")) for c in columns})


def nan_binary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two categories only: ``{col}_nan`` and ``{col}_notnan``."""
    return df.withColumns(
        {c: F.when(F.col(c).isNull(), F.lit(f"{c}_nan")).otherwise(F.lit(f"{c}_notnan")) for c in columns}
    )


def plurals(df: DataFrame, column: str) -> DataFrame:
    """Each word followed by its plural."""
    return df.select(F.explode(F.array(F.col(column), F.concat(F.col(column), F.lit("s")))).alias(column))


def ranges(df: DataFrame, column: str, start: int = 1) -> DataFrame:
    """Each integer x as the integers ``start .. x - 1``."""
    counted = df.filter(F.col(column) > start)
    return counted.select(F.col(column), F.explode(F.sequence(F.lit(start), (F.col(column) - 1).cast("int"))).alias("value"))
