import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from terrace.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="terrace-test-ckpt-")
    s = get_spark("local[4]", app="terrace-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": ckpt, "spark.default.parallelism": "4"})
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="terrace-test-")
