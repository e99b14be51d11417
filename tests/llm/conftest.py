import pytest
from pyspark.sql import types as T

DOC_TYPES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang, source) rows."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_TYPES).repartition(parts)
    return make


#: Rows that every operator over documents must take: nulls, empty texts, blanks, repeated rows, a very long text.
ODD_ROWS = [(1, None, None, None), (2, "", "en", "s0"), (3, " \t\n", None, "s1"), (4, "plain words here", "en", None),
            (4, "plain words here", "en", None), (None, "no id at all in this row", "de", "s1"),
            (5, "Ünïcödé 🙂 テキスト", "fr", "s0"), (6, "long " * 60_000, "en", "s0")]


@pytest.fixture
def odd_docs(make_docs):
    return make_docs(ODD_ROWS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOC_TYPES)
