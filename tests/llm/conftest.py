import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # columns whose names clash with those the operators make
    T.StructField("size", T.StringType()), T.StructField("component_id", T.StringType()),
    T.StructField("__key", T.StringType()), T.StructField("__id", T.StringType()),
    T.StructField("n_words", T.StringType()), T.StructField("shard", T.StringType()),
    T.StructField("line", T.StringType()), T.StructField("doc", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("blob", T.StringType())])

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30000))
BODY = ("the quick brown fox jumps over the lazy dog while seven grey wolves sleep under a "
        "very old oak tree near the river and nobody in the village hears a single sound")
TEXTS = [
    (1, BODY, "en", "a"), (1, BODY, "en", "a"),                   # a repeated row
    (2, BODY, "en", "b"), (3, BODY + " tonight", "en", None),
    (4, None, "en", "a"), (5, "", None, "b"), (6, "  \t\n ", "fr", "a"),
    (None, BODY, "en", "a"), (None, "a row without an id", None, None),
    (7, LONG, "en", "a"), (8, "x" * 5000, "en", "b"),
    (9, "first line 12\nsecond line\nfirst line 99\nCopyright 2001 ACME", "en", "c"),
    (10, "first line 7\nother words here\nCopyright 1999 ACME", "en", "c"),
    (11, "first line 8\nCopyright 2020 ACME", "de", "c"),
    (12, "Grüße aus Köln 　 \xa0 — naïve 日本語テキスト 🙂🙂 don't I'll 3.14", "de", "c"),
    (13, "password = hunter2hunter2 and token: abc", "en", "d"),
    (14, "AKIA" + "Q" * 20 + " deadbeef" * 3 + " " + "0123456789abcdef" * 2, "en", "d"),
    (15, "<|endoftext|> it's  two   spaces \x1c\x85 end ", "en", "d"),
    (16, "aaaa" * 100, "en", "d"), (17, "ab" * 300 + BODY, "en", "d"),
]


@pytest.fixture(scope="session")
def rows():
    return TEXTS


@pytest.fixture(scope="session")
def docs(spark):
    data = [(i, t, la, s, None if t is None else len(t), *["x"] * 10) for i, t, la, s in TEXTS]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
