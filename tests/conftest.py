import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodgelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app="lodgelake-tests")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="lodgelake-test-", dir="/tmp")
