import pytest
from pyspark.sql import types as T

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) tuples; each column may be null."""
    def build(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
        df = spark.createDataFrame(full, DOC)
        if extra:  # names that the operators use inside
            for name in ("key", "f", "shard", "part", "row", "m", "failed", "rank", "length", "score", "found", "id"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


LONG = "lorem ipsum dolor " * 40_000
ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, "one"), (5, "one"), (None, "two words"), (None, None),
       (6, "Ünïcode ﬁ 漢字 😀   x y"), (7, "tab\tand\x0bvertical\x0cfeed\r\nline")]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD, extra=True)
