import hashlib

import pytest
from pyspark.sql import Row

#: Columns named like those the operators use inside.
CLASHES = "doc key row rows words size sum copy spans terms score part shard class fp group bucket _id _key".split()


def frame(spark, texts, sources=None):
    """(doc_id, text, lang, source, n_chars) from texts, ids from 0."""
    sources = sources or ["s"] * len(texts)
    rows = [(i, t, "en", s, len(t) if t is not None else None) for i, (t, s) in enumerate(zip(texts, sources, strict=True))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts, sources=None: frame(spark, texts, sources)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows, clashing column names."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (None, None, None, None, None), (1, "", "en", None, 0), (2, None, "en", "a", None), (3, long, None, "a", len(long)),
        (4, "one two three", "en", "b", 13), (4, "one two three", "en", "b", 13), (5, "ONE two  three", "en", "b", 14),
        (None, "mail me@example.org now", "en", "b", 23), (6, "x" * 50_000, "en", "b", 50_000),
        (7, "漢字 ▁ \U0001F600 \t\r\n end", "en", "c", 12), (8, " \n ", "en", "c", 3),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    for name in CLASHES:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([Row(doc_id=4, quality=1, toxic=0), Row(doc_id=4, quality=0, toxic=0), Row(doc_id=1, quality=0, toxic=0),
                                  Row(doc_id=None, quality=None, toxic=None)], "doc_id long, quality int, toxic int")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()
