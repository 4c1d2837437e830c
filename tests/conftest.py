import os
import sys
import time
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

os.environ["TZ"] = "UTC"  # literal datetimes in tests are UTC
time.tzset()

from wavelane import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "wavelane-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__python__sql__dataFrameDebugging__enabled="false",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(shared),
        spark__sql__warehouse__dir=str(shared / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
