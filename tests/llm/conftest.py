import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """documents from (doc_id, text) or (doc_id, text, lang) tuples, over several partitions"""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src0", len(r[1]) if r[1] is not None else None)
                for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make
