import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs or whole rows."""

    def make(rows):
        full = [r if len(r) == 5 else (*r, "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


ODD_TEXTS = [None, "", " \t\n\x0b\x0c\r", "word", "é ß 日本 🙂 \x00 \x1f \x85 \xa0", "a" * 5000, "x y\n" * 3000, "@" * 50 + "1." * 50]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and long texts, repeated rows and a repeated key."""
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no key", None, None, None), (None, None, None, None, None), (3, "word"), (3, "another word under one key")]
    return make_docs(rows)
