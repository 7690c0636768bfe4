import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from paths import TESTDATA  # noqa: E402

from salescast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("salescast-tests", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("test data not available")
    return str(folder)
