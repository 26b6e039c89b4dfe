import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A table from rows; types come from the schema text."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
