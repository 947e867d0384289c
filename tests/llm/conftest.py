import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of texts (ids from 0), or of ``(id, text)`` pairs."""

    def made(texts):
        pairs = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs], DOCUMENTS)

    return made


@pytest.fixture(scope="session")
def small_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
