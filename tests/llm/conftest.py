"""Fixtures of the training-data operators."""

import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
LAYOUT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def small(spark):
    """The smallest driver table of documents."""
    return spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(5).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and further columns with an operator's own names."""
    words = " ".join(f"word{i % 977}x{i % 31}" for i in range(4000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. " * 5, "en", "a", 5),
        (1, "The quick brown fox jumps over the lazy dog. " * 5, "en", "a", 5),
        (2, None, None, None, None),
        (3, "", "en", None, 0),
        (4, " \t\n\x0b ", None, "b", 5),
        (5, words, "en", "a", len(words)),
        (6, words + " tail", None, "b", None),
        (None, "text without an id, 123 !? ümläut 漢字 🙂", "de", "a", 3),
        (None, None, None, None, None),
        (7, "12345 67890", "xx", "é", 11),
        (8, "un\n\n\ndeux  trois\r\nun\n", "fr", "a", 3),
    ]
    table = spark.createDataFrame(rows, LAYOUT)
    for name in ("size", "kept", "key", "n", "score", "block", "row", "target", "a", "b", "component", "_block", "words"):
        table = table.withColumn(name, F.lit("clash"))
    return table


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], LAYOUT)
