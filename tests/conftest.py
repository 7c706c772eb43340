import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from searchlake.session import get_spark

    s = get_spark("local[4]", **{"spark.sql.shuffle.partitions": "4"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="searchlake-test-ckpt-"))
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
