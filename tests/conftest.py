import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from dimflow.session import get_session
    s = get_session("local[4]", app="dimflow-tests", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def duck():
    from dimflow.plans.verify import duck_connect
    return duck_connect(SF_SMALL)
