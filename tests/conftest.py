import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from veridra.session import local_session, ship

    session = local_session(cpus=int(os.environ.get("TEST_CPUS", "4")), memory="4g", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()
