import pytest
from pyspark.sql import types as T

from ..conftest import SMALL, spark  # noqa: F401

LONG = "the thand of ther and tion ingre " * 4000  # 132,000 characters

#: doc_id, text, lang, source
EDGES = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, ""), (4, "12 34 !?", "en", "a"),
    (5, "one", "en", "a"), (6, "one", "en", "b"), (6, "one", "en", "b"), (7, LONG, "en", "a"),
    (8, "one two three four", None, "b"), (None, "one two three four", "fr", None), (9, "ÀÉ straße ▁ 中文 🙂", "de", "a"),
    (10, "a a a a a a a a a a a a a a a a a a a a a a", "en", "b"), (-3, "tab\tand\nline\n\nline\nline", "en", "c"),
]
#: Names that operators add or use themselves.
EXTRA = ["score", "rejected", "fp", "s", "h", "start", "size", "ids", "lang_pred", "key", "kept", "n_words", "answer"]


@pytest.fixture(scope="session")
def edges(spark):  # noqa: F811
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in EXTRA)])
    rows = [(i, t, lang, s, len(t or ""), *["x"] * len(EXTRA)) for i, t, lang, s in EDGES]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def small(spark):  # noqa: F811
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def key(row):
    return tuple((x is None, x) if not isinstance(x, list) else (False, str(x)) for x in row)
