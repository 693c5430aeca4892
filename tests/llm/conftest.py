import pandas as pd
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, n_words long"
EDGES = [
    (1, "A plain text. Of two\nlines, more or less.\nlines, more or less.", "en", "s1", 9, "x", 1),
    (1, "A plain text. Of two\nlines, more or less.\nlines, more or less.", "en", "s1", 9, "x", 1),  # a repeated row
    (1, "another text under the same id", "en", "s1", 9, "x", 1),
    (None, "a text without an id", None, None, None, None, None),
    (2, None, None, "s2", None, None, None),
    (3, "", "en", "s2", 0, "", 0),
    (4, " \n\t\n ", "en", None, 5, "y", 0),
    (5, "Ünï cödé — 漢字 \u00a0 ｆｕｌｌ\r\nÜNÏ CÖDÉ\x0bx\x00y", "xx", "s3", 5, "y", 0),
    (6, "word " * 30000, "en", "s3", 150000, "y", 0),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, an empty and a very long text, ties, repeated rows and columns named as the operators' own."""
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample():
    """All documents of the smallest data."""
    return pd.read_parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def by_id():
    def collect(df, *columns):
        return {r[0]: tuple(r)[1:] for r in df.select(*columns).collect()}

    return collect
