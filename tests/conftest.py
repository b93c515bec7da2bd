import pytest

from tidemart.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g", app="tests")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, for comparison."""

    def read(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return read
