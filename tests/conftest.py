import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohortframe.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cf-test-"))
    yield s


SF = "/root/testdata/sf0.001"
