import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ladle.session import checkpoint_dir, get_session
    s = get_session("local[4]", app="ladle-tests", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF001
