import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daygrain.session import ensure_shared_dir, get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="daygrain-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    ensure_shared_dir(s, tempfile.mkdtemp(prefix="dg-test-shared-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
