import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from headgate.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sd():
    return SMALL
