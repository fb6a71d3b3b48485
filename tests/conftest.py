import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from meterproof.session import build_session, use_local_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "meterproof-tests",
        spark__master="local[8]",
        spark__driver__memory="6g",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    use_local_dir(session)
    yield session
    session.stop()
