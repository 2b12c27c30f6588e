from __future__ import annotations

import os
import sys
import time

import pytest

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        "8",
        **{
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
        },
    )
    yield session
    session.stop()
