import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session, ensure_checkpoint_dir

    s = build_session(app="strata-tests", master="local[4]", shuffle_partitions=4)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="strata-test-")
