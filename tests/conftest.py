import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session, checkpoint_dir
    warehouse = tempfile.mkdtemp(prefix="tidemark-wh-")
    s = get_session("tidemark-tests", master="local[4]", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": warehouse,
                           "spark.driver.memory": "4g"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-")
