import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidepanel.session import ensure_checkpoint_dir, get_spark
    s = get_spark("local[*]", app="tidepanel-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="tidepanel-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tidepanel-test-")
