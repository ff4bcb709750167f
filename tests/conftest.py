import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from auditlens.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="auditlens-test-ckpt-")
    s = get_spark("local[4]", 4, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
