import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from logintake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[*]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet")
