import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from chronolode.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
