import pytest

from ledgerstar.llm.common import table


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return table(spark, sf, "documents")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)
