import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import checkpoint_dir, local_session

    s = local_session("4", shuffle_partitions=8, app="ledgerlake-tests")
    # tests only: install a checkpoint folder when the session names none
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="ll-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
