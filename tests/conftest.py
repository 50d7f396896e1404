import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caseweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.driver.memory": "6g", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
