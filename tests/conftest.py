import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripspark.session import get_session, shared_dir

    s = get_session("local[4]", app_name="tripspark-tests", shuffle_partitions=8)
    shared_dir(s)  # registers a checkpoint dir when none is configured
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(spark):
    from tripspark.session import scratch_path

    return scratch_path(spark, "test")
