from __future__ import annotations

import pytest

#: Rows that every operator must get through: nulls, blanks, ties, repeats, a very long text.
HARD = [
    (1, "The quick brown fox jumps over the lazy dog by the river bank. " * 4),
    (2, "The quick brown fox jumps over the lazy dog by the river bank. " * 4),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (6, "short"),
    (7, "😀 ünïcödé Text, mit Umlauten: äöü 漢字 a\x00b"),
    (8, "word " * 30_000),
    (None, "a row without an id"),
    (9, "repeated row"),
    (9, "repeated row"),
]
NAMES = ("id", "fp", "key", "rank", "kept", "count", "n", "lost_id", "own_sha", "words", "value")


@pytest.fixture
def hard(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(HARD, "doc_id long, text string")
    return docs.withColumns({c: F.lit(1) for c in NAMES})


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")
