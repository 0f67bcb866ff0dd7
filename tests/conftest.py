import pytest

from tests.check import connect, session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session(4)


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="session")
def sf():
    return SMALL
