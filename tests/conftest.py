import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revmill.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("work"))
    session = local_session("4", "revmill-tests", "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
