import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wideframe.session import get_spark
    # tests own their checkpoint folder (a cluster names a shared one)
    ck = tempfile.mkdtemp(prefix="wideframe-test-ckpt-")
    s = get_spark("local[4]", app="wideframe-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": ck})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="wideframe-test-")
