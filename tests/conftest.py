import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lifetide.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # few upsert buckets: test tables are tiny (production default is 64)
    s = build_session("local[*]", app="lifetide-tests", shuffle_partitions=8,
                      extra={"lifetide.upsert.buckets": "4"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lifetide-test-")
