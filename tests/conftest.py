import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulseledger.config import Config  # noqa: E402
from pulseledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(cores=8, shuffle_partitions=4, **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture
def cfg():
    return Config(as_of=datetime(2024, 1, 31, 12), enable_identity_stitching=True)
