import os

import pytest

from tests.conftest import spark  # noqa: F401  (the session fixture)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, `h1` string, shard int, `a.b` string"


@pytest.fixture(scope="session")
def long_text():
    return " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000)) + "\n" + "z" * 50_000


@pytest.fixture(scope="session")
def edge_docs(spark, long_text):  # noqa: F811
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    line = "a line of twenty and more characters"
    rows = [
        (1, line + "\n" + line, "en", "s1", 1, True, "x", 1, "q"),
        (1, line + "\n" + line, "en", "s1", 1, True, "x", 1, "q"),          # repeated row
        (1, "another text under the same id " * 3, "de", "s2", None, None, None, None, None),
        (2, None, "en", "s1", None, True, "x", 1, "q"),
        (3, "", "en", None, 0, True, "x", 1, "q"),
        (4, " \t\r\n ", None, "s3", 3, True, "x", 1, "q"),
        (None, line + "!", None, None, 5, None, None, None, None),
        (None, "no id here, but twenty characters", "fr", "s2", 5, None, None, None, None),
        (5, long_text, "en", "s1", 7, False, "y", 2, "r"),
        (6, "Grüße, été, \U0001F600 漢字 漢字   end of it all", "fr", "s2", 9, False, "y", 2, "r"),
        (7, "123 456 !!!", "es", "s2", 9, False, "y", 2, "r"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):  # noqa: F811
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):  # noqa: F811
    return spark.read.parquet(os.path.join(SF, "documents.parquet"))


@pytest.fixture(scope="session")
def doc_rows(documents):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in documents.collect()]
