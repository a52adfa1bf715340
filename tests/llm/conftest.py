import pytest
from pyspark.sql import types as T

DATA = "/root/testdata/sf0.001"

#: Columns that operators might use themselves, beside those of documents.
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
                    + [T.StructField(c, T.StringType()) for c in ("label", "toxic", "fold", "length", "rank", "key", "m", "text_id", "class_id", "block", "kinds", "values")])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of [(doc_id, text)] with extra columns of clashing names, nulls among them."""
    def build(rows):
        return spark.createDataFrame([(i, t, None if k % 3 == 0 else "en", "s", len(t or "")) + (None if k % 2 else "x",) * 12 for k, (i, t) in enumerate(rows)], DOCS)
    return build


LONG = "word " * 60_000 + "end"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id at all here"), (5, LONG), (6, "same words in this one here"), (7, "same words in this one here")]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
