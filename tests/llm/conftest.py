import pytest
from pyspark.sql import types as S

DOCS = S.StructType([S.StructField("doc_id", S.LongType()), S.StructField("text", S.StringType()),
                     S.StructField("lang", S.StringType()), S.StructField("n_words", S.StringType()),
                     S.StructField("id", S.StringType()), S.StructField("score", S.StringType()),
                     S.StructField("row", S.StringType())])


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) pairs, with columns whose names the operators use themselves."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "w", "x", "s", "r") for i, t in rows], DOCS).repartition(3)
    return make


@pytest.fixture(scope="session")
def odd(frame):
    """Null ids, null, empty and blank texts, repeated rows, ties, a very long text."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    return frame([(None, None), (1, None), (2, ""), (3, "  \n "), (4, base), (4, base), (5, base), (None, base),
                  (6, "word"), (7, "two words"), (8, "É " * 50_000 + "end"), (9, "a" * 300_000),
                  (10, base + " thirteen"), (11, "\U0001d4b3 emoji \U0001f600 text")])
