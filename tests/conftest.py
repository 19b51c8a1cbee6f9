import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sedgemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", 4, "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
