import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import spark_session
    s = spark_session("local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture()
def scratch(spark):
    from tidemark.session import scratch_path
    return scratch_path(spark, "test")
