import pytest
from pyspark.sql import functions as F

from llm_helpers import SMALL


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with Python workers that find this repository."""
    from finmart.llm.common import workers_find_package
    workers_find_package(spark)
    return spark


@pytest.fixture(scope="session")
def small_docs(llm):
    return llm.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and
    extra columns whose names clash with those that operators use inside."""
    long = " ".join(f"word{i % 977} and more" for i in range(60_000))
    rows = [(1, "The quick brown fox jumps over the lazy dog. " * 8, "en", "a", 1),
            (2, "", "en", "a", 0), (3, None, None, None, None), (None, "no id here", "en", "b", 3),
            (None, None, None, None, None), (4, "   \n\t ", "de", "b", 5),
            (5, "twice the same row", "en", "c", 2), (5, "twice the same row", "en", "c", 2),
            (5, "same id, other text", "en", "c", 2), (6, long, "en", "a", 9),
            (7, "The quick brown fox jumps over the lazy dog. " * 8, "fr", None, 1),
            (8, "ümläut ñandú 日本語 \U0001f600 <|endoftext|> \x1c x", "es", "", 4)]
    df = llm.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for i, name in enumerate(["fp", "key", "first", "size", "target", "copies", "_size", "_id", "_hash",
                              "cid", "n", "score", "s", "piece", "slope", "which", "y", "_text"]):
        df = df.withColumn(name, F.lit(i))
    return df
