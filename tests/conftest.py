import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reviewloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = local_session(8, "tests", **{"spark.checkpoint.dir": str(checkpoints)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    def rows(df):
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return rows


@pytest.fixture
def plan_of():
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return plan
