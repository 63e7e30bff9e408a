import pytest
from pyspark.sql import types as T

from tidystar.llm.common import share_package

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # names that operators use for their own columns
                     T.StructField("score", T.StringType()), T.StructField("ids", T.StringType()),
                     T.StructField("node", T.StringType()), T.StructField("class_key", T.StringType()),
                     T.StructField("stage_score", T.StringType()), T.StructField("stage_lang", T.StringType())])

#: Long enough that it is cut into pieces.
LONG = "alpha beta, gamma's 42 delta\n" * 200_000
ODD_TEXTS = [None, "", " \t\n ", "one", "One TWO", "one  two", "ein Wort für ÄÖÜ", "x" * 5000, "!!! ??? 123",
             "<|endoftext|> it's <b>", "á 中文 \U0001f600 \x1c\u0085", "same text here", "same text here"]


@pytest.fixture(scope="session", autouse=True)
def _package(spark):
    share_package(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text[, lang])."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), *["x"] * 6) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """NULL ids and texts, empty and very long texts, repeated rows, clashing columns."""
    rows = [(i, t, "en") for i, t in enumerate(ODD_TEXTS)] + [(None, "no id at all", None), (3, "one", "en"), (99, LONG, "en")]
    return make_docs(rows)
