import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("DOCINDEX_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from docindex.session import build_session

    s = build_session("local[4]", 4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
