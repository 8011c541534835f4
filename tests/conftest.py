import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cumulus.session import build_session
    s = build_session("cumulus-tests", master="local[4]", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cumulus-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch(spark):
    from cumulus.session import scratch_path
    return lambda name: scratch_path(spark, name)
