from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from fitloom.session import build_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session("tests", 8, **{"spark.checkpoint.dir": shared, "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return TESTDATA
