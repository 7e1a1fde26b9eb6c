from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, lang, source, n_chars]) as a documents table, with clashing extra columns."""
    def make(rows, extra=()):
        full = [tuple(r) + ("en", "src0", len(r[1]) if r[1] is not None else None)[len(r) - 2:] if len(r) < 5 else tuple(r) for r in rows]
        df = spark.createDataFrame(full, DOC)
        for name in extra:
            df = df.selectExpr("*", f"'x' as `{name}`")
        return df
    return make


#: Null id, null text, empty, blank, repeated rows, a very long text.
EDGE_ROWS = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, ""), (4, " \n\t "), (None, "x y z w v u"), (None, None),
             (5, "long " * 40000 + "end"), (6, "short"), (7, "a b c d e f g"), (8, "naïve 日本 🙂 text\nline\nline")]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    rows = [(*r, None if k % 3 == 0 else "en", None if k % 4 == 0 else "src0", None if k % 5 == 0 else 10) for k, r in enumerate(EDGE_ROWS)]
    return make_docs(rows, extra=("score", "fingerprint", "_fp", "near", "shard", "bucket", "_rid", "text_score", "component_id", "key", "y"))


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return make
