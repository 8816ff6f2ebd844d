import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pressflow.session import local_session

    session = local_session(4, "4g")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Apply a column expression to each value of a list and return the results."""
    def apply(values, expression, ddl="STRING"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i INT, v {ddl}")
        out = df.select("i", expression(df["v"]).alias("out")).orderBy("i").collect()
        return [r["out"] for r in out]
    return apply
