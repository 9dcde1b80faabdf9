import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from farelens.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()
