import pytest
from corpus_rows import DOCS, make_docs


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(make_docs(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
