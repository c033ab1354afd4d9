import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from gapscan.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, memory="6g")
    yield s
    s.stop()
