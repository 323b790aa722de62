import pytest
from llm_helpers import DOCUMENTS, odd_rows, with_extra


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(with_extra(odd_rows()), DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(n, n % 3 % 2, int(n % 5 == 0)) for n in range(100, 140)] + [(None, 1, 1), (1, None, None), (101, 1, 1), (101, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
