import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType()), T.StructField("rid", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text) pairs, with an extra column whose name operators use inside."""
    def make(pairs, parts=3):
        rows = [(i, t, "en", "src", None if t is None else len(t), "clash") for i, t in pairs]
        return spark.createDataFrame(rows, DOC).repartition(parts)
    return make
