import pytest

from .rows import SCHEMA, awkward


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Awkward documents with unique ids."""
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def odder_docs(spark):
    """The same with null and repeated ids."""
    return spark.createDataFrame(awkward(unique=False), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
