import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

S = dt.datetime(2025, 6, 1)   # snapshot of the reference's own fixtures


@pytest.fixture(scope="session")
def spark():
    from churnlake.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="churnlake-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def params():
    from churnlake.params import Params
    return Params(snapshot=S)


def days(n):
    return S + dt.timedelta(days=n)


@pytest.fixture(scope="session")
def spark_session_for_props(spark):
    return spark
