import pytest
from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shared(spark):
    """The session, whose shared folder the tests set."""
    return spark


@pytest.fixture(scope="session")
def documents(shared):
    return shared.read.parquet(f"{FOLDER}/documents.parquet")


ODD = [
    # doc_id, text, lang, source
    (1, "The quick brown fox jumps over the lazy dog again and again today", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog again and again today", "en", "a"),
    (2, "the Quick brown fox  jumps over\tthe lazy dog again and again today", None, None),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \n\t ", "en", None),
    (6, "two words", "en", "b"),
    (None, "two words", "en", "b"),
    (None, None, None, None),
    (7, "long " * 40_000 + "end", "en", "a"),
    (8, "x" * 100_000, None, "a"),
    (9, "café über \U0001f600 naïve 　 wide", "fr", "c"),
]


@pytest.fixture(scope="session")
def odd(shared):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like the operators' own."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "n_words", "key_", "h1", "row_no", "rank", "bucket"]
    kinds = [T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.LongType(), *[T.StringType()] * 6]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return shared.createDataFrame([(*r, len(r[1] or ""), "q", None, "x", "y", "z", "b") for r in ODD], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
