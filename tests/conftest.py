import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fleetspark.session import get_spark
    s = get_spark("local[4]", app="fleetspark-tests", shuffle_partitions=8, extra={"spark.driver.memory": "12g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fs-test-ckpt-"))
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
