import pytest

from vitarium.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from vitarium.session import scratch_path

    return lambda name: scratch_path(spark, name)
