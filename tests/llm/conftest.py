from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import RARE  # noqa: E402


@pytest.fixture
def rare(spark):
    """The odd rows, with columns that clash with names the operators use."""
    ddl = "doc_id bigint, text string, n_words string, block string, fp string, hits string, _tw_keep string, row string, lang string, toxic int"
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x", "x", "en", 0) for i, t in RARE], ddl)


@pytest.fixture
def nothing(rare):
    return rare.where("1 = 0")
