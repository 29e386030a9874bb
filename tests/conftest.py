import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimweave.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        initial_partitions=4,
        settings={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def plain(df):
    """Rows as a sorted list of tuples, nested rows as tuples too."""

    def value(v):
        if isinstance(v, (list, tuple)):
            return tuple(value(x) for x in v)
        return v

    return sorted((tuple(value(v) for v in row) for row in df.collect()), key=repr)
