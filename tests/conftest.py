import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from clickweave.session import build_session

    shared = str(tmp_path_factory.mktemp("shared"))
    s = build_session(
        app="tests", master="local[4]", shuffle_partitions=4, driver_memory="6g", **{"spark.checkpoint.dir": shared}
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
