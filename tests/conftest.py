import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="strata-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
