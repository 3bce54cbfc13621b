import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tickloom.session import local_session  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, 4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return str(DATA)
