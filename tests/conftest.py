import os
import sys

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

import pytest  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from garimpo.workspace import session

    s = session("tests", "4", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
