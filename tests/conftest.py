import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loanflow.session import checkpoint_root, local_session

    s = local_session(4, app="loanflow-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # uses spark.checkpoint.dir, or sets a temp one when the session names none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def sf_mid():
    return SF_MID
