import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from emporium.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    wh = tempfile.mkdtemp(prefix="emporium-wh-")
    s = build_session("local[4]", "emporium-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="emporium-test-")
