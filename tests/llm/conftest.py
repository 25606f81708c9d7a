import pytest


@pytest.fixture(scope="module")
def rows(spark):
    """Frames from rows and a schema, over a few partitions."""

    def make(data, schema, parts=3):
        return spark.createDataFrame(data, schema).repartition(parts)

    return make
