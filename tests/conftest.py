import pytest

from caseloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "caseloom-tests")


@pytest.fixture(scope="session")
def values(spark):
    """values(make_column, type, *inputs): the column's value for each input, in order."""
    from pyspark.sql import functions as F

    def run(make, kind, *inputs):
        rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, c {kind}")
        return [r["v"] for r in rows.select("i", make(F.col("c")).alias("v")).orderBy("i").collect()]

    return run
