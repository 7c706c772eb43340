"""Small document tables with the odd cases that every operator must bear."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and white texts, repeated rows, one id with two texts, a
    long text, and columns that clash with names used inside."""
    words = "the quick brown fox jumps over the lazy dog and runs far away from here".split()
    long = " ".join(words[i * 7 % len(words)] + str(i % 97) for i in range(20000))
    rows = [
        (1, " ".join(words), "en", "a", 1),
        (2, " ".join(words), "en", "b", 1),
        (2, " ".join(words), "en", "b", 1),
        (3, None, "en", "a", 0),
        (4, "", None, "a", 0),
        (5, " \t\n ", "de", None, 4),
        (6, "Überraschung für ÄÖÜ 日本語 \U0001F600 naïve", "de", "a", None),
        (7, "one two", "en", "a", 7),
        (8, long, "en", "a", len(long)),
        (9, long + " extra", "en", "a", len(long)),
        (10, "THE QUICK brown fox jumps over the lazy dog and runs far away from nowhere", "en", "a", 1),
        (11, "!!! ??? ...", "en", "a", 1),
        (12, "same id first text with some words in it", "en", "a", 1),
        (12, "same id second text with other words in it", "en", "a", 1),
        (None, "no id at all but words", "en", "a", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("id", "node", "digest", "word", "part", "shard", "slot", "score", "label", "text_a", "component", "h", "key"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 0, 1), (7, 1, 1), (8, 1, 0), (9, None, None), (None, 1, 1), (999, 1, 1), (7, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
