"""Projection, filters, row edits and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions import clf, text
from tabloom.operators import rows
from tabloom.plans import spread
from tabloom.queries import fixtures as fx
from tabloom.queries.registry import query, table


@query("p01_select_arithmetic", "SELECT p_name, p_size + 1 AS size_next FROM part")
def p01(spark, sf):
    return table(spark, sf, "part").select("p_name", (F.col("p_size") + 1).alias("size_next"))


@query("p02_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def p02(spark, sf):
    return table(spark, sf, "orders").filter("o_totalprice > 300000").select("o_orderkey", "o_totalprice")


@query("p03_between", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 13 AND 19")
def p03(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_size").between(13, 19)).select("p_partkey", "p_size")


@query(
    "p04_flatten_struct",
    f"WITH {fx.POSTS_SQL} SELECT id, user_id_str, user_followers_count, retweet_count FROM posts",
)
def p04(spark, sf):
    flat = rows.flatten_struct(fx.posts(spark, sf), "user", ["id_str", "followers_count"])
    return flat.select("id", "user_id_str", "user_followers_count", "retweet_count")


@query("p05_extract_label", f"WITH {fx.POSTS_SQL} SELECT source, count(*) AS n FROM posts GROUP BY source")
def p05(spark, sf):
    return fx.posts(spark, sf).groupBy(text.extract_label(F.col("source")).alias("source")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p06_conditional_overwrite",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE CAST(o_totalprice > 200000 AS INTEGER) END AS late FROM orders",
)
def p06(spark, sf):
    late = table(spark, sf, "orders").withColumn("late", (F.col("o_totalprice") > 200000).cast("int"))
    return rows.overwrite_when(late, "late", F.col("o_orderstatus") == "P", 1).select("o_orderkey", "late")


@query(
    "p07_drop_null_rows",
    f"WITH {fx.JOBS_SQL} SELECT id, title, salary FROM jobs WHERE title IS NOT NULL AND salary IS NOT NULL",
)
def p07(spark, sf):
    return rows.drop_null_rows(fx.job_ads(spark, sf), ["title", "salary"]).select("id", "title", "salary")


@query("p08_drop_out_of_range", "SELECT p_partkey, p_size FROM part WHERE p_size <= 48")
def p08(spark, sf):
    return table(spark, sf, "part").filter(~(F.col("p_size") > 48)).select("p_partkey", "p_size")


@query(
    "p09_drop_sparse_rows",
    f"""WITH {fx.JOBS_SQL} SELECT id, fraudulent FROM jobs WHERE (location IS NULL)::INT + (department IS NULL)::INT
      + (salary IS NULL)::INT + (title IS NULL)::INT < 2""",
)
def p09(spark, sf):
    ads = fx.job_ads(spark, sf)
    return rows.drop_sparse_rows(ads, 2, ["location", "department", "salary", "title"]).select("id", "fraudulent")


@query("p10_drop_null_columns", f"WITH {fx.JOBS_SQL} SELECT id, fraudulent FROM jobs")
def p10(spark, sf):
    return rows.drop_null_columns(fx.job_ads(spark, sf))


@query(
    "p11_recode",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Houses' WHEN 'MACHINERY' THEN 'Engines' ELSE c_mktsegment END AS c_mktsegment,
      n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def p11(spark, sf):
    people = table(spark, sf, "customer").withColumn("nation", F.col("c_nationkey").cast("string"))
    nations = table(spark, sf, "nation").withColumn("key", F.col("n_nationkey").cast("string"))
    named = rows.recode(people, "c_mktsegment", {"BUILDING": "Houses", "MACHINERY": "Engines"})
    return rows.recode_by(named, "nation", nations, "key", "n_name").select("c_custkey", "c_mktsegment", "nation")


@query(
    "p12_split_location",
    f"""WITH {fx.JOBS_SQL}, parts AS (SELECT id, string_split(location, ',') AS p FROM jobs)
    SELECT id, p[1] AS country, p[2] AS state, p[3] AS city FROM parts""",
)
def p12(spark, sf):
    return rows.split_location(fx.job_ads(spark, sf).select("id", "location"))


@query(
    "p13_drop_zero_coords",
    f"WITH {fx.POINTS_SQL} SELECT id, round(x, 6) AS x, round(y, 6) AS y FROM points WHERE abs(x) > 0.01 AND abs(y) > 0.01",
)
def p13(spark, sf):
    kept = rows.drop_zero_coords(fx.points(spark, sf), ["x", "y"], 0.01)
    return kept.select("id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("p14_friday_night", "SELECT event_id FROM events WHERE isodow(ts) = 5 AND hour(ts) > 21")
def p14(spark, sf):
    return table(spark, sf, "events").filter(rows.friday_night(F.col("ts"))).select("event_id")


@query("p15_dedupe", f"WITH {fx.POSTS_SQL} SELECT DISTINCT location, id FROM posts")
def p15(spark, sf):
    return rows.dedupe(fx.posts(spark, sf).select("location", "id"), ["location", "id"])


@query(
    "p16_narrow_types",
    """SELECT 'p_partkey' AS name, CASE WHEN max(p_partkey) < 127 THEN 'byte' WHEN max(p_partkey) < 32767 THEN 'smallint' ELSE 'int' END AS kind,
      CAST(sum(p_partkey) AS BIGINT) AS total FROM part
    UNION ALL SELECT 'p_size', 'tinyint', CAST(sum(p_size) AS BIGINT) FROM part
    UNION ALL SELECT 'p_retailprice', 'float', CAST(sum(floor(CAST(p_retailprice AS FLOAT))) AS BIGINT) FROM part""",
)
def p16(spark, sf):
    narrow = rows.narrow_types(table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"))
    kinds = dict(narrow.dtypes)
    sums = narrow.agg(*[F.sum(F.floor(c)).cast("long").alias(c) for c in kinds])
    return sums.unpivot([], list(kinds), "name", "total").select(
        "name", F.element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), F.col("name")).alias("kind"), "total"
    )


@query(
    "p17_slice_rows",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 40 OFFSET 3",
)
def p17(spark, sf):
    return rows.slice_rows(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], 3, 43)


# --- scalar functions -------------------------------------------------------------------


@query(
    "f01_parse_log",
    f"""WITH {fx.LOG_SQL} SELECT event_id, host, '-' AS client_identd, '-' AS user_id,
      strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time, 'GET' AS method, endpoint, 'HTTP/1.0' AS protocol,
      response_code, content_size FROM logs""",
)
def f01(spark, sf):
    parsed = clf.parse_clf(fx.log_lines(spark, sf)).filter("parsed")
    return parsed.drop("line", "parsed").withColumn("date_time", F.date_format("date_time", "yyyy-MM-dd HH:mm:ss"))


@query(
    "f02_log_time",
    f"WITH {fx.LOG_SQL} SELECT event_id, strftime(date_time, '%Y/%m/%d %H-%M-%S') AS time FROM logs",
)
def f02(spark, sf):
    time = F.regexp_extract("line", r"\[([^\]]+)\]", 1)
    lines = fx.log_lines(spark, sf).filter(F.col("line").contains("["))
    return lines.select("event_id", F.date_format(clf.parse_clf_time(time), "yyyy/MM/dd HH-mm-ss").alias("time"))


@query("f03_log_size", f"WITH {fx.LOG_SQL} SELECT event_id, content_size FROM logs")
def f03(spark, sf):
    lines = fx.log_lines(spark, sf).filter(F.col("line").startswith("host"))
    return lines.select("event_id", clf.clf_size(F.element_at(F.split("line", " "), -1)).alias("content_size"))


@query(
    "f04_parse_report",
    """SELECT 'fixed' AS pattern, count(*) AS lines_read, count(*) FILTER (event_id % 97 <> 0) AS lines_parsed,
      count(*) FILTER (event_id % 97 = 0) AS lines_failed FROM events
    UNION ALL SELECT 'strict', count(*), count(*) FILTER (event_id % 97 <> 0 AND event_id % 50 <> 0),
      count(*) FILTER (event_id % 97 = 0 OR event_id % 50 = 0) FROM events""",
)
def f04(spark, sf):
    lines = fx.log_lines(spark, sf)
    fixed = clf.parse_report(clf.parse_clf(lines)).withColumn("pattern", F.lit("fixed"))
    strict = clf.parse_report(clf.parse_clf(lines, fixed=False)).withColumn("pattern", F.lit("strict"))
    return fixed.unionByName(strict)


@query(
    "f05_date_parts",
    """SELECT event_id, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
      CAST(isodow(ts) - 1 AS INTEGER) AS weekday FROM events""",
)
def f05(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday")
    )


@query(
    "f06_movie_year_name",
    f"""WITH {fx.MOVIES_SQL} SELECT item_id, CAST(1950 + item_id % 60 AS INTEGER) AS year,
      regexp_extract(title, '^(.*)\\(', 1) AS name FROM movies""",
)
def f06(spark, sf):
    return fx.movies(spark, sf).select(
        "item_id", text.movie_year(F.col("title")).alias("year"), text.movie_name(F.col("title")).alias("name")
    )


@query("f08_array_to_string", f"WITH {fx.POSTS_SQL} SELECT id, array_to_string(hashtags, ',') AS tags FROM posts")
def f08(spark, sf):
    return fx.posts(spark, sf).select("id", F.concat_ws(",", "hashtags").alias("tags"))


@query(
    "f09_merge_text",
    f"""WITH {fx.JOBS_SQL} SELECT id, coalesce(title, '') || ' ' || coalesce(department, '') || ' ' || coalesce(location, '') AS text
    FROM jobs""",
)
def f09(spark, sf):
    return fx.job_ads(spark, sf).select("id", text.merge_text(["title", "department", "location"]).alias("text"))


@query(
    "f10_remove_url",
    "SELECT page_id, regexp_replace(html, 'https?://\\S+|www\\.\\S+', '', 'g') AS text FROM pages",
)
def f10(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.remove_url(F.col("html")).alias("text"))


EMOJI_SQL = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
)


@query(
    "f11_remove_emoji",
    f"SELECT doc_id, regexp_replace(text || chr(128512) || ' ok ' || chr(128640), '{EMOJI_SQL}', '', 'g') AS text FROM documents",
)
def f11(spark, sf):
    marked = F.concat(F.col("text"), F.lit("\U0001f600 ok \U0001f680"))
    return table(spark, sf, "documents").select("doc_id", text.remove_emoji(marked).alias("text"))


@query("f12_remove_html", "SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS text FROM pages")
def f12(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.remove_html(F.col("html")).alias("text"))


PUNCT_SQL = text.PUNCTUATION.replace("'", "''")


@query("f13_remove_punct", f"SELECT doc_id, translate(text, '{PUNCT_SQL}', '') AS text FROM documents")
def f13(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.remove_punct(F.col("text")).alias("text"))


def _contractions_sql(expr: str) -> str:
    for ending, words in text.CONTRACTIONS:
        expr = f"replace({expr}, '{ending.replace(chr(39), chr(39) * 2)}', '{words}')"
    return expr


SPOKEN = "replace(replace(replace(text, ' the ', ' won''t '), ' and ', '''ll '), ' is ', 'n''t ')"


@query("f14_expand_contractions", f"SELECT doc_id, {_contractions_sql(SPOKEN)} AS text FROM documents")
def f14(spark, sf):
    spoken = F.expr("replace(replace(replace(text, ' the ', \" won't \"), ' and ', \"'ll \"), ' is ', \"n't \")")
    return table(spark, sf, "documents").select("doc_id", text.expand_contractions(spoken).alias("text"))


STOPS_SQL = "[" + ", ".join(f"'{w}'" for w in text.STOP_WORDS) + "]"


@query(
    "f15_normalize_text",
    f"""SELECT doc_id, lower(array_to_string(list_filter(string_split(trim(regexp_replace(
      replace(replace(replace(text, '\\r', ' '), '\\"', ' '), '\\n', ' '), '[^A-Za-z0-9]+', ' ', 'g')), ' '),
      lambda w: NOT list_contains({STOPS_SQL}, lower(w))), ' ')) AS text FROM documents""",
)
def f15(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", text.normalize_text(F.col("text")).alias("text"))


@query(
    "f16_punct_to_words",
    """SELECT doc_id, replace(replace(replace(replace(text, '!', ' exclamation '), '?', ' question '),
      '''', ' quotation '), '"', ' quotation ') AS text FROM documents""",
)
def f16(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.punct_to_words(F.col("text")).alias("text"))


TOKENS_SQL = r"""list_filter(list_transform(
  regexp_extract_all(regexp_replace(text, '(?i)(n''t|''(s|re|ve|ll|d|m))\b', ' ', 'g'),
  '[\p{L}\p{N}_]+([-./][\p{L}\p{N}_]+)*', 0), lambda w: w), lambda w: regexp_full_match(w, '\p{L}+'))"""


@query("f17_tokenize", f"SELECT doc_id, array_to_string({TOKENS_SQL}, ' ') AS tokens FROM documents")
def f17(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", F.array_join(text.tokenize(F.col("text")), " ").alias("tokens"))


@query(
    "f18_remove_stopwords",
    f"""SELECT doc_id, array_to_string(list_filter({TOKENS_SQL}, lambda w: NOT list_contains({STOPS_SQL}, w)), ' ') AS tokens
    FROM documents""",
)
def f18(spark, sf):
    kept = text.remove_stopwords(text.tokenize(F.col("text")))
    return spread(table(spark, sf, "documents")).select("doc_id", F.array_join(kept, " ").alias("tokens"))


@query(
    "f19_string_hash",
    """SELECT p_partkey, CAST(list_reduce(list_concat([0::BIGINT], list_transform(string_split(p_name, ''), lambda ch: CAST(unicode(ch) AS BIGINT))),
      lambda h, ch: (h * 1024 + ch) % 257) AS BIGINT) AS h257,
      CAST(list_reduce(list_concat([0::BIGINT], list_transform(string_split(p_name, ''), lambda ch: CAST(unicode(ch) AS BIGINT))),
      lambda h, ch: (h * 1024 + ch) % 750) AS BIGINT) AS h750 FROM part""",
)
def f19(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", text.string_hash(F.col("p_name")).alias("h257"), text.string_hash(F.col("p_name"), 750).alias("h750")
    )


@query(
    "f22_nan_category",
    f"""WITH {fx.JOBS_SQL} SELECT id, coalesce(nullif(department, ''), 'department_nan') AS department,
      CASE WHEN title IS NULL THEN 'title_nan' ELSE 'title_notnan' END AS title FROM jobs""",
)
def f22(spark, sf):
    ads = rows.nan_category(fx.job_ads(spark, sf), ["department"])
    return rows.nan_binary(ads, ["title"]).select("id", "department", "title")


@query(
    "f23_strip_number",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE floor(o_totalprice) END AS price FROM orders",
)
def f23(spark, sf):
    spaced = F.expr(
        "CASE WHEN o_orderkey % 9 = 0 THEN ':' ELSE replace(format_number(floor(o_totalprice), 0), ',', ' ') END"
    )
    return table(spark, sf, "orders").select("o_orderkey", text.strip_number(spaced).alias("price"))


@query(
    "f24_map_filter",
    "SELECT p_partkey, p_size * 2 - 1 AS twice, p_size % 7 AS rest FROM part WHERE p_size % 2 = 0 AND NOT (p_size < 10)",
)
def f24(spark, sf):
    kept = table(spark, sf, "part").filter((F.col("p_size") % 2 == 0) & ~(F.col("p_size") < 10))
    return kept.select("p_partkey", (F.col("p_size") * 2 - 1).alias("twice"), (F.col("p_size") % 7).alias("rest"))


@query(
    "f25_flat_map",
    """SELECT p_name AS word, count(*) AS n FROM (SELECT unnest([p_name, p_name || 's']) AS p_name FROM part) GROUP BY 1
    UNION ALL SELECT CAST(v AS VARCHAR), count(*) FROM (SELECT unnest(range(1, p_size)) AS v FROM part) GROUP BY 1""",
)
def f25(spark, sf):
    part = table(spark, sf, "part")
    names = rows.plurals(part, "p_name").groupBy(F.col("p_name").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    numbers = rows.ranges(part, "p_size").groupBy(F.col("value").cast("string").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return names.unionByName(numbers)


@query("f26_json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def f26(spark, sf):
    return table(spark, sf, "events").select("event_id", text.json_field(F.col("props"), "$.k").cast("int").alias("k"))
