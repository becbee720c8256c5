import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def documents(spark):
    """Builds documents from (doc_id, text[, source]) rows."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return build


LONG = "lorem " * 40_000 + "x" * 50_000


@pytest.fixture
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    return [(1, None), (2, ""), (3, "  \n\t "), (None, "an orphan text"), (5, "the same text"), (5, "the same text"), (6, "the same text"),
            (7, LONG), (8, "Grüße, 日本語 and 🙂\n\nnew line"), (9, "<|endoftext|> special <|startoftext|>")]
