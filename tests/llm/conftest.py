import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """doc_id -> text of the small table."""
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


LONG = " ".join(f"word{i % 997}" for i in range(30_000))
ODD = [
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, "  \t\n ", "en", "a", 5),
    (None, "some text without an id", "en", "a", 3),
    (5, "Some Text, with UPPER case and ÄÖÜ ß é", "de", "b", 3),
    (5, "Some Text, with UPPER case and ÄÖÜ ß é", "de", "b", 3),
    (6, LONG, "en", "a", None),
    (7, LONG + " end", "en", None, None),
    (8, "x" * 200_000, "en", "a", None),
    (9, "日本語のテキスト 😀 and 12345 numbers", "ja", "c", None),
    (10, "1234 5678 !!", "en", "a", None),
]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rows = [(*r, "x", 1) for r in ODD]
    return spark.createDataFrame(rows, SCHEMA + ", component_id string, kept int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
