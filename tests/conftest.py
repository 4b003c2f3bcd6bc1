import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kmerscope.session import get_session

    s = get_session("local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kmerscope-test-"))
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
