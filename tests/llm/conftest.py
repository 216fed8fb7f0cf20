import pytest
from pyspark.sql import types as T

from tests.conftest import SMALL

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.StringType()), T.StructField("fingerprint", T.StringType())])

LONG = "the quick brown fox jumps over the lazy dog and runs away from here today\n" * 4000


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named as the operators name theirs."""
    rows = [
        (1, None, None, "x"), (2, "", "n", None), (3, " \t\n", "n", "x"), (4, "one", "n", "x"), (5, LONG, "n", "x"), (5, LONG, "n", "x"),
        (6, LONG, "n", "x"), (None, "words without an id that stand here for a while", "n", "x"), (None, None, None, None),
        (7, "A <|endoftext|> b  c   d   e\n\n\nf g　h <|startoftext|> it's", "n", "x"), (8, "Été İstanbul ΣΣ straße näive 12,5%. \U0001f600\U0001f600 한국어", "n", "x"),
        (9, "x" * 30000, "n", "x"), (10, "one", "n", "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df, *columns):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
