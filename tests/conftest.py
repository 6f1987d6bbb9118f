import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from headway.session import build

    s = build("tests", master="local[8]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
