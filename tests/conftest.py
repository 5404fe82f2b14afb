import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeload.session import get_session

    s = get_session("local[4]", app="lakeload-tests", **{"spark.sql.shuffle.partitions": "4"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeload-test-ckpt-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_base():
    return tempfile.mkdtemp(prefix="lakeload-test-")
