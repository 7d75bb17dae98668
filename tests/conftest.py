import pytest

from capledger.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "capledger-tests", master="local[4]",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g", spark__driver__host="localhost",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
