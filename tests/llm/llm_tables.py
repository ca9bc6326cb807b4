import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows): a table like documents from (doc_id, text) or (doc_id, text, source), with
    columns whose names the operators use themselves."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", "'x' as node", "1 as size", "'k' as key", "2 as n", "3 as score", "4 as h", "5 as shard")
    return make


SF = "/root/testdata/sf0.001"
