import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import build_session

    session = build_session(
        "tests",
        master="local[8]",
        time_zone="UTC",
        shuffle_partitions=4,
        options={"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.driver.host": "127.0.0.1", "spark.driver.bindAddress": "127.0.0.1"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
