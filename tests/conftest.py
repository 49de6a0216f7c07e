import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from keysweep.session import local_session
    s = local_session(4, shuffle_partitions=8, app="keysweep-tests")
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def scratch(spark):
    from keysweep.scratch import Scratch
    return Scratch(spark)


def rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
