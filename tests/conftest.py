import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package by path.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import checkpoint_root, local_session

    s = local_session(cores=4, shuffle_partitions=4, app="strata-tests")
    checkpoint_root(s)  # sets a scratch checkpoint folder only when the session has none
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from strata.session import shared_path

    return shared_path(spark, "tests", unique=True)
