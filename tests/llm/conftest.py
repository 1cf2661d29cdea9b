"""Helpers of the operator tests; the session comes from the tests above."""

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs(spark):
    """A small table of documents from (doc_id, text) rows, over several partitions."""

    def make(rows, schema=DOCS, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make
