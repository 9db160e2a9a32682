import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daymark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, name="daymark-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Text of a frame's physical plan."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def one(spark):
    """Values of an expression over a list of inputs in column ``x``."""

    def run(values, expression, data_type="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {data_type}")
        return [row["y"] for row in rows.select("i", expression.alias("y")).orderBy("i").collect()]

    return run
