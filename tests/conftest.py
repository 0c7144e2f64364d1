import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ordermart.session import local_session
    s = local_session("*", shuffle_partitions=8, app="ordermart-tests")
    yield s
    from ordermart.plans.sinks import clean_scratch
    clean_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture()
def scratch(spark):
    import uuid

    from ordermart.plans.sinks import scratch_root
    return f"{scratch_root(spark)}/tests-{uuid.uuid4().hex}"
