from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regiontally.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        master="local[*]",
        app_name="regiontally-tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"},
    )
    yield session
    session.stop()
