import pytest

from partylens.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Sorted result rows as tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
