import pytest

from lotwise.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
