import pytest

from riskpanel.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", 4, app_name="riskpanel-tests",
                            spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
                            spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
