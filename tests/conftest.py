import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tidemark.session import get_session, scratch  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", 8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    from tidemark.sources.lake import Lake

    return Lake(spark, scratch(spark, "test-lake"))


def pairs(df):
    return sorted(tuple(r) for r in df.collect())
