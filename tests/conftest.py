import pytest

from feedmill.session import build_session

SF_TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__default__parallelism="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_TINY
