import pytest

from tests.llm.helpers import documents, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, odd_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])
