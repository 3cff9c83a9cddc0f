import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weeksignal.session import local_session, ship_package  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
