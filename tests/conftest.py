import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from qaforge.session import get_spark

    s = get_spark("qaforge-tests", master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf0001():
    return SF0001
