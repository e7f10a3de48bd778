import sys
import tempfile

import pytest
from helpers import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session

    s = local_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    """A fresh directory per test."""
    return str(tmp_path)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="quarry-test-")
