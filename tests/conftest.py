import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from carelens.session import get_spark
    s = get_spark("local[4]", app="carelens-tests", shuffle_partitions=8)
    # Tests write to the session's shared folder; give them their own when unset.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="carelens-test-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from carelens.session import scratch_path
    return lambda name: scratch_path(spark, "tests", name)
