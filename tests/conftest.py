import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohortlens.session import build_session, checkpoint_root
    s = build_session("local[4]", app="cohortlens-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)          # registers a folder only if none is configured
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cohortlens-test-")


SF = "/root/testdata/sf0.001"
