import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from millrace.session import build
    s = build("local[4]", 4, app="millrace-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def refs(spark):
    from millrace.sources.seeds import Refs
    return Refs(spark)
