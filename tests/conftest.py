import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ferry.session import build_session
    s = build_session("local[4]", 8, app_name="ferry-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # A fresh folder per test; never cleared by the tests themselves.
    return tempfile.mkdtemp(prefix="ferry-test-")
