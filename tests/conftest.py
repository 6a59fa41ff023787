from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewind import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame(rows, ddl): a small DataFrame."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)
