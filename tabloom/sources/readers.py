"""Scans: each returns a DataFrame with named, typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines. Give a schema on large inputs: inferring one costs a pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def load(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Generic load; Parquet is the default source."""
    return spark.read.format(fmt).options(**options).load(path)


def sql_on_file(spark: SparkSession, path: str, where: str, columns: str = "*", fmt: str = "parquet") -> DataFrame:
    """SQL directly on a file; the filter reaches the scan."""
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{path}` WHERE {where}")


def read_csv(
    spark: SparkSession, path: str, null: str = "NA", schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header and a null token; types inferred unless a schema is given."""
    reader = spark.read.option("header", True).option("nullValue", null)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def lines_to_table(spark: SparkSession, path: str, names: str) -> DataFrame:
    """Comma-separated text with a schema given as a string of names; fields are trimmed."""
    parts = F.split("value", ",")
    return read_lines(spark, path).select(
        *[F.trim(F.try_element_at(parts, F.lit(i + 1))).alias(n) for i, n in enumerate(names.split())]
    )


def read_separated(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "::") -> DataFrame:
    """Headerless latin-1 text with a separator of one or more characters."""
    return spark.read.option("sep", sep).option("encoding", "ISO-8859-1").schema(schema).csv(path)


RATINGS = "user_id long, item_id long, rating double, timestamp long"
USERS = "user_id long, gender string, age int, occupation int, zip string"
MOVIES = "item_id long, title string, genres string"


def read_ratings(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three ``::`` files of a ratings folder."""
    return {
        "ratings": read_separated(spark, f"{folder}/ratings.dat", RATINGS),
        "users": read_separated(spark, f"{folder}/users.dat", USERS),
        "movies": read_separated(spark, f"{folder}/movies.dat", MOVIES),
    }


def read_zip_city(spark: SparkSession, path: str) -> DataFrame:
    """``Zip;City`` with a header. The zip stays text, so leading zeros survive."""
    return spark.read.option("sep", ";").option("header", True).schema("zip string, city string").csv(path)


def read_eurostat(spark: SparkSession, path: str) -> DataFrame:
    """Wide TSV whose first column packs ``a,b,c\\time``; ``:`` is null, letter flags after a number go.

    Returns the key columns as text and one double column per year, named by the year.
    """
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    packed, *years = raw.columns
    keys = [k.strip() for k in packed.split("\\")[0].split(",")]
    parts = F.split(F.col(f"`{packed}`"), ",")

    def number(c: str):
        return F.regexp_replace(F.col(f"`{c}`"), r"[^0-9.]+$", "").try_cast("double")

    return raw.select(
        *[F.trim(parts[i]).alias(k) for i, k in enumerate(keys)],
        *[number(y).alias(y.strip()) for y in years],
    )


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    """One basket per line: trimmed, trailing comma dropped, split on commas."""
    line = F.regexp_replace(F.trim("value"), ",+$", "")
    return read_lines(spark, path).select(F.split(line, ",").alias("items"))


def html_to_text(col):
    """Visible text of an HTML page: head, scripts, styles, comments and tags removed."""
    text = F.regexp_replace(col, r"(?is)<!--.*?-->|<(script|style|head)\b.*?</\1\s*>", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    # fixed values: the five predefined entities and the no-break space
    for entity, char in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
    ):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def read_html_docs(spark: SparkSession, glob: str, id_pattern: str = r"(\d+)\.html$") -> DataFrame:
    """One row per HTML file: id from the file name, the raw page and its visible text."""
    raw = spark.read.text(glob, wholetext=True, recursiveFileLookup=True)
    return raw.select(
        F.regexp_extract(F.col("_metadata.file_path"), id_pattern, 1).try_cast("long").alias("id"),
        F.regexp_replace("value", r"\n$", "").alias("html"),
    ).withColumn("text", html_to_text(F.col("html")))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edge list with ``%`` comments, 1-based in the file and 0-based here."""
    fields = F.split(F.trim("value"), r"\s+")
    return (
        read_lines(spark, path)
        .filter(~F.col("value").startswith("%") & (F.trim("value") != ""))
        .select((fields[0].cast("long") - 1).alias("src"), (fields[1].cast("long") - 1).alias("dst"))
    )


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated numbers, one matrix row per line, as ``row array<double>``."""
    fields = F.split(F.trim("value"), r"\s+")
    return (
        read_lines(spark, path)
        .filter(F.trim("value") != "")
        .select(F.transform(fields, lambda x: x.cast("double")).alias("row"))
    )


def from_rows(spark: SparkSession, rows: Sequence, names: Sequence[str] | str) -> DataFrame:
    """A small in-memory collection as a table."""
    return spark.createDataFrame(rows, names)


def integers(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Integers ``start <= id < end``."""
    return spark.range(start, end)
