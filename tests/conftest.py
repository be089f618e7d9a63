import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{TESTDATA}/sf0.01"
