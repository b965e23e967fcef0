import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """``rows(schema, list of tuples)`` as a DataFrame."""
    return lambda schema, data: spark.createDataFrame(data, schema)
