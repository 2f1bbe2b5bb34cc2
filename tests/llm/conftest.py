import pytest
from pyspark.sql import types as T

#: Columns that no operator reads, named like what operators use inside.
CLASHES = ["text_hash", "h", "body", "copies", "cid", "component", "n", "w", "ids", "score", "kept", "tie", "pack_group", "row"]


def documents(spark, rows, extra=True):
    """(doc_id, text) rows with columns whose names operators also use."""
    names = CLASHES if extra else []
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(n, T.StringType()) for n in names)])
    return spark.createDataFrame([(i, t, *("?" for _ in names)) for i, t in rows], schema)


@pytest.fixture
def docs(spark):
    return lambda rows, extra=True: documents(spark, rows, extra)
