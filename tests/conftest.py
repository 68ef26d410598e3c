import pytest

from tests.compare import make_session


@pytest.fixture(scope="session")
def spark():
    session = make_session("4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
