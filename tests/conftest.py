import pytest

from jobmine.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", "4", "6g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("staging")))
    yield session
    session.stop()
