import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Make a frame from rows and a DDL schema."""

    def make(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return make


@pytest.fixture
def value(spark):
    """Evaluate a column over literal inputs, one result per input."""
    from pyspark.sql import functions as F

    def run(build, kind, *inputs):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
        return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]

    return run
