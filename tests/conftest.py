import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from repsmith.session import get_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="repsmith-tests")
    checkpoint_dir(s)  # unset in tests -> a scratch folder (local mode only)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="repsmith-test-", dir="/tmp")
