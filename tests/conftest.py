import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, nulls first."""

    def collect(frame, *names):
        found = [tuple(row) for row in (frame.select(*names) if names else frame).collect()]
        return sorted(found, key=lambda row: tuple((value is not None, str(value)) for value in row))

    return collect


@pytest.fixture
def violations():
    def collect(frame):
        return {row["check"]: row["violations"] for row in frame.collect()}

    return collect


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().toString()
