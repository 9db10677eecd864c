import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gaugelake.session import get_session, ship_package

    session = get_session("tests", "local[4]", 4, str(tmp_path_factory.mktemp("shared")))
    ship_package(session)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
