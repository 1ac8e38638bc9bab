import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")


@pytest.fixture(scope="session")
def spark():
    from carelake.session import local_session

    s = local_session(4, shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.exists(SMALL):
        pytest.skip("driver test data not present")
    return SMALL


@pytest.fixture(scope="session")
def data_path():
    return lambda name: os.path.join(DATA, name)
