import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from examlytics.session import local_session
    s = local_session(cores=4, shuffle_partitions=8, app="examlytics-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def analytics(spark):
    import __spark_entry__ as E
    return E.analytics(spark, SF_SMOKE)
