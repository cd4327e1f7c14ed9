"""Scans and sinks: each writes a given table in one format and reads it back."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.plans import scratch_path, spread
from tabloom.queries import fixtures as fx
from tabloom.queries.registry import query, table
from tabloom.sources import readers, writers

CUSTOMERS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("s01_read_json", CUSTOMERS)
def s01(spark, sf):
    path = scratch_path(spark, "json")
    table(spark, sf, "customer").write.json(path)
    return readers.read_json(spark, path).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("s02_load_format", CUSTOMERS)
def s02(spark, sf):
    path = scratch_path(spark, "orc")
    writers.save(table(spark, sf, "customer"), path, fmt="orc")
    return readers.load(spark, path, "orc")


@query("s03_load_parquet", "SELECT p_partkey, p_name, p_retailprice FROM part")
def s03(spark, sf):
    return readers.load(spark, f"{sf}/part.parquet").select("p_partkey", "p_name", "p_retailprice")


@query("s04_sql_on_file", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def s04(spark, sf):
    return readers.sql_on_file(spark, f"{sf}/orders.parquet", "o_totalprice > 250000", "o_orderkey, o_totalprice")


@query(
    "s05_read_csv_nulls",
    "SELECT event_id, event_type, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM events",
)
def s05(spark, sf):
    path = scratch_path(spark, "csv")
    events = table(spark, sf, "events").selectExpr(
        "event_id", "event_type", "CASE WHEN event_id % 10 = 0 THEN 'NA' ELSE CAST(value AS STRING) END AS value"
    )
    events.write.option("header", True).csv(path)
    return readers.read_csv(spark, path).select(F.col("event_id").cast("long").alias("event_id"), "event_type", "value")


@query("s06_read_lines", "SELECT c_name || ' | ' || c_mktsegment AS value FROM customer")
def s06(spark, sf):
    path = scratch_path(spark, "lines")
    table(spark, sf, "customer").selectExpr("c_name || ' | ' || c_mktsegment AS value").write.text(path)
    return readers.read_lines(spark, path)


@query("s07_lines_to_table", "SELECT p_name AS name, CAST(p_size AS VARCHAR) AS age FROM part")
def s07(spark, sf):
    path = scratch_path(spark, "people")
    table(spark, sf, "part").selectExpr("concat(p_name, ', ', p_size) AS value").write.text(path)
    return readers.lines_to_table(spark, path, "name age")


@query(
    "s08_read_ratings",
    f"""WITH {fx.RATINGS_SQL}, {fx.MOVIES_SQL}
    SELECT r.user_id, r.item_id, CAST(rating AS DOUBLE) AS rating, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
      c_nationkey AS occupation, title, genres
    FROM ratings r JOIN customer ON r.user_id = c_custkey JOIN movies m ON r.item_id = m.item_id""",
)
def s08(spark, sf):
    folder = scratch_path(spark, "ratings")
    people = table(spark, sf, "customer").selectExpr(
        "concat_ws('::', c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END, 25, c_nationkey, '08001') AS value"
    )
    lines = {
        "ratings": fx.ratings(spark, sf).selectExpr("concat_ws('::', user_id, item_id, rating, unix_timestamp(ts)) AS value"),
        "users": people,
        "movies": fx.movies(spark, sf).selectExpr("concat_ws('::', item_id, title, genres) AS value"),
    }
    for name, df in lines.items():
        df.write.option("encoding", "ISO-8859-1").text(f"{folder}/{name}.dat")
    read = readers.read_ratings(spark, folder)
    joined = read["ratings"].join(read["users"], "user_id").join(read["movies"], "item_id")
    return joined.select("user_id", "item_id", "rating", "gender", "occupation", "title", "genres")


@query("s09_read_zip_city", "SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS zip, c_name AS city FROM customer")
def s09(spark, sf):
    path = scratch_path(spark, "zip")
    rows = table(spark, sf, "customer").selectExpr("lpad(CAST(c_custkey AS STRING), 6, '0') AS Zip", "c_name AS City")
    rows.write.option("header", True).option("sep", ";").csv(path)
    return readers.read_zip_city(spark, path)


def _yearly(y: int) -> str:
    return f'CAST(max(CASE WHEN y = {y} AND n % 3 <> 0 THEN CASE WHEN n % 5 = 0 THEN -n ELSE n END END) AS DOUBLE) AS "{y}"'


@query(
    "s10_read_eurostat",
    f"""WITH cells AS (SELECT o_orderpriority AS unit, o_orderstatus AS geo, year(o_orderdate) AS y, count(*) AS n
      FROM orders GROUP BY 1, 2, 3)
    SELECT 'N' AS sectfund, replace(unit, ' ', '_') AS unit, geo, {", ".join(map(_yearly, fx.ORDER_YEARS))}
    FROM cells GROUP BY 1, 2, 3""",
)
def s10(spark, sf):
    path = scratch_path(spark, "eurostat")
    packed = "sectfund,unit,geo\\time"
    wide = (
        table(spark, sf, "orders")
        .select(
            F.expr("concat_ws(',', 'N', replace(o_orderpriority, ' ', '_'), o_orderstatus)").alias(packed),
            F.year("o_orderdate").alias("y"),
        )
        .groupBy(packed)
        .pivot("y", fx.ORDER_YEARS)
        .count()
    )

    def flagged(y):
        n = F.col(f"{y}")
        signed = F.when(n % 5 == 0, -n).otherwise(n)
        return F.when(n % 3 == 0, ": ").otherwise(F.concat(signed.cast("string"), F.lit(" e"))).alias(f"{y} ")

    wide.select(packed, *map(flagged, fx.ORDER_YEARS)).write.option("header", True).option("sep", "\t").csv(path)
    return readers.read_eurostat(spark, path)


@query(
    "s11_read_baskets",
    f"""WITH {fx.BASKETS_SQL}, lists AS (SELECT basket, list_sort(list(item)) AS items FROM baskets GROUP BY basket)
    SELECT array_to_string(items, '+') AS items, CAST(len(items) AS BIGINT) AS n FROM lists""",
)
def s11(spark, sf):
    path = scratch_path(spark, "baskets")
    lists = fx.basket_items(spark, sf).groupBy("basket").agg(F.sort_array(F.collect_set("item")).alias("items"))
    lists.select(F.concat(F.lit(" "), F.array_join("items", ","), F.lit(",")).alias("value")).write.text(path)
    return readers.read_baskets(spark, path).select(
        F.array_join("items", "+").alias("items"), F.size("items").cast("long").alias("n")
    )


@query("s12_read_html_docs", "SELECT page_id AS id, html FROM pages")
def s12(spark, sf):
    path = scratch_path(spark, "html")
    pages = spread(table(spark, sf, "pages").select("page_id", "html"))
    pages.write.partitionBy("page_id").text(path)
    return readers.read_html_docs(spark, path, r"page_id=(\d+)/").select("id", "html")


@query("s13_read_edges", f"WITH {fx.EDGES_SQL} SELECT src, dst FROM edges")
def s13(spark, sf):
    path = scratch_path(spark, "edges")
    rows = fx.edges(spark, sf).select(F.concat_ws(" ", F.col("src") + 1, F.col("dst") + 1).alias("value"))
    note = rows.groupBy().agg(F.concat(F.lit("% edges: "), F.count(F.lit(1)).cast("string")).alias("value"))
    rows.unionByName(note).write.text(path)
    return readers.read_edges(spark, path)


@query(
    "s14_read_matrix",
    """SELECT CAST(embedding[1] AS DOUBLE) AS id, CAST(len(embedding) AS BIGINT) AS n,
      round(list_sum(list_transform(embedding, lambda v: round(CAST(v AS DOUBLE), 4))), 4) AS total
    FROM (SELECT list_concat([CAST(vec_id AS FLOAT)], embedding) AS embedding FROM embeddings)""",
)
def s14(spark, sf):
    path = scratch_path(spark, "matrix")
    rows = fx.vectors(spark, sf).select(
        F.concat_ws(" ", F.col("id").cast("string"), F.transform("vec", lambda v: F.format_string("%.4f", v))).alias("value")
    )
    rows.write.text(path)
    total = F.round(F.aggregate("row", F.lit(0.0), lambda a, v: a + v), 4)
    return readers.read_matrix(spark, path).select(
        F.col("row")[0].alias("id"), F.size("row").cast("long").alias("n"), total.alias("total")
    )


@query("s15_save_columns", "SELECT s_suppkey, s_name FROM supplier")
def s15(spark, sf):
    path = scratch_path(spark, "columns")
    writers.save(table(spark, sf, "supplier"), path, columns=["s_suppkey", "s_name"])
    return readers.load(spark, path)


@query("s16_save_overwrite", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 0")
def s16(spark, sf):
    path = scratch_path(spark, "overwrite")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    writers.save(suppliers, path)
    writers.save(suppliers.filter("s_acctbal > 0"), path, mode="overwrite")
    return readers.load(spark, path)


@query("s17_managed_table", CUSTOMERS)
def s17(spark, sf):
    name = f"tabloom_customer_{uuid.uuid4().hex}"
    writers.save_table(table(spark, sf, "customer"), name)
    return spark.table(name)


@query("s18_external_table", "SELECT p_partkey, p_brand, p_size FROM part")
def s18(spark, sf):
    name = f"tabloom_part_{uuid.uuid4().hex}"
    writers.save_table(table(spark, sf, "part").select("p_partkey", "p_brand", "p_size"), name, path=scratch_path(spark, "part"))
    return spark.table(name)


@query("s19_save_partitioned", "SELECT event_type, event_id, value FROM events")
def s19(spark, sf):
    path = scratch_path(spark, "by-type")
    writers.save_partitioned(table(spark, sf, "events").select("event_type", "event_id", "value"), path, "event_type")
    return readers.load(spark, path)


@query(
    "s20_save_csv_by_key",
    f"WITH {fx.POSTS_SQL} SELECT location, id, retweet_count, array_to_string(hashtags, ',') AS hashtags FROM posts",
)
def s20(spark, sf):
    path = scratch_path(spark, "csv-by-location")
    rows = fx.posts(spark, sf).select("location", "id", "retweet_count", "hashtags")
    writers.save_csv_by(rows, path, "location")
    return spark.read.option("header", True).schema("id long, retweet_count int, hashtags string, location string").csv(path)


@query(
    "s21_save_documents",
    """SELECT c_custkey AS zip, c_name AS city, c_mktsegment AS weather,
      CAST(DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR) AS created_at FROM customer""",
)
def s21(spark, sf):
    path = scratch_path(spark, "documents")
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey AS zip", "c_name AS city", "string(date_add(DATE'2020-01-01', int(c_custkey % 365))) AS created_at",
        "to_json(named_struct('main', c_mktsegment)) AS weather",
    )
    writers.save_documents(rows, path)
    back = readers.read_json(spark, path, "zip long, city string, created_at string, weather string")
    return back.select("zip", "city", F.get_json_object("weather", "$.main").alias("weather"), "created_at")


@query(
    "s22_save_topn",
    f"""WITH {fx.RATINGS_SQL}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM ratings)
    SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY rank) AS prediction
    FROM ranked WHERE rank <= 5 GROUP BY user_id""",
)
def s22(spark, sf):
    path = scratch_path(spark, "topn")
    best = fx.ratings(spark, sf).selectExpr(
        "*", "row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank"
    )
    writers.save_topn(best, path, 5)
    return spark.read.option("header", True).schema("user_id long, prediction string").csv(path)


@query("s23_save_load_model", f"WITH {fx.SCORED_SQL} SELECT doc_id, true AS same FROM scored")
def s23(spark, sf):
    """A reloaded pipeline must score every row as the fitted one does."""
    path = scratch_path(spark, "model")
    data = fx.scored(spark, sf)
    stages = [VectorAssembler(inputCols=["score"], outputCol="features"), LogisticRegression(maxIter=5)]
    fitted = Pipeline(stages=stages).fit(data)
    writers.save_model(fitted, path)
    before = fitted.transform(data).select("doc_id", vector_to_array("probability").alias("before"))
    after = writers.load_model(path).transform(data).select("doc_id", vector_to_array("probability").alias("after"))
    return before.join(after, "doc_id").select("doc_id", (F.col("before") == F.col("after")).alias("same"))


@query(
    "s24_from_rows",
    """SELECT name, count(*) AS n FROM orders
    JOIN (VALUES ('O', 'open'), ('F', 'filled'), ('P', 'pending')) AS s(code, name) ON o_orderstatus = code GROUP BY name""",
)
def s24(spark, sf):
    names = readers.from_rows(spark, [("O", "open"), ("F", "filled"), ("P", "pending")], ["code", "name"])
    orders = table(spark, sf, "orders").select("o_orderstatus")
    return orders.join(names, F.col("o_orderstatus") == F.col("code")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s25_range_table",
    """SELECT id, count(l_orderkey) AS n FROM range((SELECT max(o_orderkey) + 10 FROM orders)) t(id)
    LEFT JOIN lineitem ON l_orderkey = id GROUP BY id""",
)
def s25(spark, sf):
    last = table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").count()
    ids = readers.integers(spark, 0, last + 10)
    return ids.join(lines, F.col("id") == F.col("l_orderkey"), "left").select("id", F.coalesce("count", F.lit(0)).alias("n"))
