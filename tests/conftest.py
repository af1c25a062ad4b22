from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", cores=8, spark__checkpoint__dir=str(shared), spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from millrace.session import workspace

    path = Path(workspace(spark, "test"))
    path.mkdir(parents=True)
    return path
