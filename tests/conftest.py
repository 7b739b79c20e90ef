import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from snapstats.session import build_session

    session = build_session(
        "snapstats-tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR
