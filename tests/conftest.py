import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textloom import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "textloom-tests", "local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions="8",
        spark_driver_memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
