import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000
#: missing values, empty and very long texts, ties, repeated rows
EDGE = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, LONG, "en", "a", len(LONG)), (3, LONG, "en", "a", len(LONG)),
        (None, "no id here", "en", None, 10), (None, None, None, None, None), (4, " \n\t ", "en", "b", 4),
        (5, "mail a.b@c.example.org, call +1 (555) 123-4567 or 10.0.0.256 10.0.0.25", "en", "b", 70),
        (6, "x" * 50_000, "en", "b", 50_000), (7, "1" * 50_000 + "@", "en", "c", 50_001)]


@pytest.fixture
def edge(spark):
    rows = spark.createDataFrame(EDGE, DOCS)
    # names that working columns might use
    return rows.selectExpr("*", "1 AS row", "2 AS size", "'z' AS fp", "3 AS k", "4 AS id", "5 AS copies", "6 AS found", "7 AS h",
                           "8 AS n_words", "9 AS base", "10 AS pos", "11 AS tree", "12 AS prefix")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
