import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lapsewise.session import build_session, use_private_checkpoints

    s = build_session("local[4]", app_name="lapsewise-tests", shuffle_partitions=4)
    use_private_checkpoints(s)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="lapsewise-test-", dir="/tmp")
