import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tessellate.session import get_session
    s = get_session("local[4]", 4, "tessellate-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessellate-test-"))
    yield s
    s.stop()


SMOKE = "/root/testdata/sf0.001"
