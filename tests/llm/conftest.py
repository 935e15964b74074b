import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # Names that operators use inside.
        T.StructField("size", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("rank", T.StringType()),
    ]
)
LABELS = "doc_id long, quality int, toxic int, text string"

LONG = "lorem ipsum dolor sit amet consectetur " * 4000


@pytest.fixture
def documents(spark):
    """Makes a documents table from (doc_id, text, lang, source) rows, with extra columns."""

    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)), *"abcde") for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def awkward(documents):
    """NULLs in any column, empty and very long texts, repeated rows and ids, copies, no letters."""
    return documents(
        [
            (0, "one two three four five six seven eight", "en", "a"),
            (1, "one two three four five six seven eight", "en", "b"),
            (2, None, "de", None),
            (3, "", None, "a"),
            (4, LONG, "en", "a"),
            (4, LONG, "en", "a"),
            (5, " \t\n ", "fr", "c"),
            (6, "123 456 !!! 789", None, None),
            (None, "one two three four five six seven eight", "en", "a"),
            (None, None, None, None),
            (7, "short text", "fr", "b"),
            (7, "other words of the same id", "fr", "b"),
            (8, "Ünïcödé \U0001f600 日本語 text \u0000 end", "de", "d"),
        ]
    )


@pytest.fixture
def none(documents):
    """An empty documents table."""
    return documents([])
