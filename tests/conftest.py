import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from matchlore.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("test tables are not here")
    return str(folder)
