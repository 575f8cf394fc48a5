import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from orderloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = get_session(
        "orderloom-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(shared),
        spark__sql__warehouse__dir=str(shared / "warehouse"),
        spark__ui__showConsoleProgress="false",
    )
    yield session
    session.stop()
