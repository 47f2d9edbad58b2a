import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from labelloop.session import get_spark
    s = get_spark("local[4]", app="labelloop-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="labelloop-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE
