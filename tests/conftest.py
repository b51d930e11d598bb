import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from roadpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark_sql_shuffle_partitions="4",
                            spark_ui_enabled="false", spark_driver_memory="4g",
                            spark_sql_maxMetadataStringLength="2000")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
