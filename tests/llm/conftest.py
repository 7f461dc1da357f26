import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """Small tables: rows(data, schema)."""
    return lambda data, schema: spark.createDataFrame(data, schema)
