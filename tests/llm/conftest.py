import pytest

DOCS = "doc_id long, text string, lang string, key string, id long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(30_000)) + " " + "x" * 20_000
    texts = [None, "", "a", "a", "same words in both of these texts here", "same words in both of these texts here", long, "  \n ", "Ünïcode ½ ’quoted’ \x1c end"]
    rows = [(i, t, None, "k", None) for i, t in enumerate(texts)] + [(2, "a", "en", None, 7)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
