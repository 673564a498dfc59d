from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="module")
def documents(spark):
    """A frame of documents from (doc_id, text) pairs."""
    return lambda rows: spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"
