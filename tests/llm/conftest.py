"""Odd tables that every operator must take."""

import pytest

LONG = " ".join(f"word{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, null ids and sources, repeated rows, a long text, and columns whose names clash."""
    rows = [
        (1, None, None, "en", 0), (2, "", "s", "en", 0), (3, " \n\t ", "s", None, 0), (None, "one two three", "s", "en", 0),
        (5, "the same text of ten words stands here twice over now", "s", "en", 0), (5, "the same text of ten words stands here twice over now", "s", "en", 0),
        (7, LONG, "s", "en", 0), (8, "x" * 50_000, "t", "de", 0),
    ]
    names = "doc_id bigint, text string, source string, lang string, n_chars bigint"
    plain = spark.createDataFrame(rows, names)
    more = {"score": "1", "h": "2", "key": "3", "t1": "4", "host": "5", "start": "6", "words": "7", "a": "8", "b": "9", "_key": "10"}
    return plain.selectExpr("*", *[f"'{v}' AS {k}" for k, v in more.items()])


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return odd_docs.limit(0)
