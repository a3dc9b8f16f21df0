import pytest
from corpus_cases import frame, rows_of_documents


@pytest.fixture
def messy_rows():
    return rows_of_documents()


@pytest.fixture
def messy(spark, messy_rows):
    return frame(spark, messy_rows).repartition(4)


@pytest.fixture
def no_documents(spark):
    return frame(spark, [(1, "text")]).limit(0)
