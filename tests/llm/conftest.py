import pytest
from pyspark.sql import types as T

from candlewick.llm.texts import ship_package

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from ``[(doc_id, text), ...]``, with other columns and some of their values null."""
    ship_package(spark)

    def make(rows, partitions=3):
        full = [(i, t, None if k % 2 else "en", "s", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions) if rows else spark.createDataFrame([], DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def rows_of():
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
