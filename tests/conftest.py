import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from custlens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="custlens-tests", shuffle_partitions=4)
    yield s


@pytest.fixture()
def tmpdir_spark(tmp_path):
    return str(tmp_path)
