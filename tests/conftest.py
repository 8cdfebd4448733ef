import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import build_session, checkpoint_dir

    s = build_session(master=os.environ.get("TIDEWATCH_TEST_MASTER", "local[4]"), shuffle_partitions=8, app="tidewatch-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
