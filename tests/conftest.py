import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app_name="starloom-tests")
    checkpoint_dir(s, tempfile.mkdtemp(prefix="starloom-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    return tempfile.mkdtemp(prefix="case-", dir=checkpoint_dir(spark))
