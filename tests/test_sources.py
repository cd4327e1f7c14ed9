"""Readers and writers on small literal files."""

import pytest
from pyspark.sql import functions as F

from tabloom.operators import udfs
from tabloom.plans import shared_dir
from tabloom.sources import readers, writers


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_text(text, encoding=encoding)
    return str(path)


def test_json_with_missing_field(spark, tmp_path):
    path = write(tmp_path, "people.json", '{"name":"Ann"}\n{"name":"Bob","age":30}\n')
    rows = {r["name"]: r["age"] for r in readers.read_json(spark, path).collect()}
    assert rows == {"Ann": None, "Bob": 30}


def test_csv_null_token(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,b\n1,NA\nNA,x\n")
    df = readers.read_csv(spark, path)
    assert dict(df.dtypes)["a"] == "int"
    assert sorted(map(tuple, df.collect()), key=str) == [(1, None), (None, "x")]


def test_programmatic_schema(spark, tmp_path):
    path = write(tmp_path, "people.txt", "Michael, 29\nAndy, 30\nJustin,  19 \n")
    assert sorted(map(tuple, readers.lines_to_table(spark, path, "name age").collect())) == [
        ("Andy", "30"), ("Justin", "19"), ("Michael", "29"),
    ]


def test_ratings_folder(spark, tmp_path):
    write(tmp_path, "ratings.dat", "1::10::5::978300760\n")
    write(tmp_path, "users.dat", "1::F::1::10::08001\n")
    write(tmp_path, "movies.dat", "10::Amélie (2001)::Comedy|Romance\n", "latin-1")
    read = readers.read_ratings(spark, str(tmp_path))
    assert tuple(read["ratings"].first()) == (1, 10, 5.0, 978300760)
    assert tuple(read["users"].first()) == (1, "F", 1, 10, "08001")
    assert tuple(read["movies"].first()) == (10, "Amélie (2001)", "Comedy|Romance")


def test_zip_keeps_leading_zeros(spark, tmp_path):
    path = write(tmp_path, "zip.csv", "Zip;City\n02101;Boston\n")
    assert tuple(readers.read_zip_city(spark, path).first()) == ("02101", "Boston")


def test_eurostat(spark, tmp_path):
    path = write(tmp_path, "e.tsv", "sectfund,unit,geo\\time\t2001 \t2002 \nA,EUR,ES\t1.5 b\t: \nA,EUR,FR\t: c\t-\n")
    df = readers.read_eurostat(spark, path)
    assert df.columns == ["sectfund", "unit", "geo", "2001", "2002"]
    assert sorted(map(tuple, df.collect())) == [("A", "EUR", "ES", 1.5, None), ("A", "EUR", "FR", None, None)]


def test_baskets_drop_trailing_comma(spark, tmp_path):
    path = write(tmp_path, "b.csv", "milk,rum,\n yogurt\nrice,milk\n")
    assert sorted(r["items"] for r in readers.read_baskets(spark, path).collect()) == [
        ["milk", "rum"], ["rice", "milk"], ["yogurt"],
    ]


def test_html_documents(spark, tmp_path):
    page = "<html><head><title>x</title></head><body><!-- c --><p>A man &amp; a\n dog</p><script>var a='<p>'</script></body></html>"
    write(tmp_path, "init7.html", page)
    row = readers.read_html_docs(spark, str(tmp_path)).first()
    assert (row["id"], row["html"], row["text"]) == (7, page, "A man & a dog")


def test_edges_and_matrix(spark, tmp_path):
    path = write(tmp_path, "e.txt", "% nodes 3\n%x\n1 2\n3\t1\n\n")
    assert sorted(map(tuple, readers.read_edges(spark, path).collect())) == [(0, 1), (2, 0)]
    path = write(tmp_path, "m.txt", "1 2.5 -3\n 4  5 6\n")
    assert sorted(r["row"] for r in readers.read_matrix(spark, path).collect()) == [[1.0, 2.5, -3.0], [4.0, 5.0, 6.0]]


def test_sql_on_file_and_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = readers.integers(spark, 0, 10)
    writers.save(df, path)
    with pytest.raises(Exception):
        writers.save(df, path)
    writers.save(df.filter("id > 4"), path, mode="overwrite")
    assert readers.sql_on_file(spark, path, "id < 7").count() == 2
    assert readers.load(spark, path).count() == 5


def test_csv_by_key_flattens_arrays(spark, tmp_path):
    df = readers.from_rows(spark, [("a", [1, 2]), ("b", [3])], ["k", "tags"])
    writers.save_csv_by(df, str(tmp_path / "c"), "k")
    back = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert sorted((r["k"], r["tags"]) for r in back.collect()) == [("a", "1,2"), ("b", "3")]


def test_topn_file(spark, tmp_path):
    df = readers.from_rows(spark, [(1, 9, 2), (1, 7, 1), (1, 5, 3), (2, 4, 1)], ["user_id", "item_id", "rank"])
    writers.save_topn(df, str(tmp_path / "s"), 2)
    back = spark.read.option("header", True).csv(str(tmp_path / "s"))
    assert sorted(map(tuple, back.collect())) == [("1", "7 9"), ("2", "4")]


def test_user_functions_and_plan(spark):
    df = spark.range(5)
    udfs.register(spark, "as_text", lambda x: x + 1)
    udfs.register(spark, "as_number", lambda x: x + 1, "long")
    row = spark.sql("SELECT as_text(id) AS a, as_number(id) AS b FROM range(4, 5)").first()
    assert (row["a"], row["b"]) == ("5", 5)
    assert df.select(udfs.column_udf(lambda x: x * x, "long")("id").alias("s")).agg(F.sum("s")).first()[0] == 30
    assert "Range" in udfs.plan_text(df)
    assert udfs.cache_state(udfs.cache(df))["cached"] and not udfs.cache_state(udfs.release(df))["cached"]


def test_shared_folder_follows_the_session(spark):
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
