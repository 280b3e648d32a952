import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakeloom import get_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    return TESTDATA


def rows(df):
    """All rows as sorted tuples; only for fixtures."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple(map(repr, row)))


def plan(df):
    """The physical plan as first planned."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]
