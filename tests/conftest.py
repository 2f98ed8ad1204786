import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tamarack.session import drop_scratch, local_session

    session = local_session(8, partitions=8)
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def root():
    return f"/root/testdata/sf{os.environ.get('TAMARACK_TEST_SF', '0.001')}"
