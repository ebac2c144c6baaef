import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from oracle_check import session

    return session("4")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="netsieve-test-")
