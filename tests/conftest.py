import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tests.session import local_session

    return local_session(cores="4", memory="6g")


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF
