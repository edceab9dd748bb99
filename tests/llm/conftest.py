"""Small tables for the operators of the training-data pipeline."""

import pytest
from pyspark.sql import types as T

DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Build a table of documents from (doc_id, text[, lang[, source]]) rows."""

    def build(rows, schema=DOCUMENTS):
        kind = T.StructType.fromDDL(schema)
        full = [tuple(r) + (None,) * (len(kind) - len(r)) for r in rows]
        return spark.createDataFrame(full, kind).repartition(3)

    return build
