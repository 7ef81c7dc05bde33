import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillcube.session import get_session
    s = get_session("local[*]", 8, app_name="tillcube-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def wh(spark, sf_dir):
    from tillcube.sources import retail
    return retail.load_warehouse(spark, sf_dir)
